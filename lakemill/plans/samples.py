"""Inputs that queries derive from the driver's tables: pages with everything that a page can have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The page's number decides what its URL gets: an address, punycode, a user, an escape and a keyword, hyphens, a port, no scheme.
ODD_URL = """CASE page_id % 8 WHEN 1 THEN regexp_replace(url, '^([a-z]+)://[^/?#]*', '\\1://10.0.' || (page_id % 200)::VARCHAR || '.7') WHEN 2 THEN replace(url, '://', '://xn--')
  WHEN 3 THEN replace(url, '://', '://user' || page_id::VARCHAR || '@') WHEN 4 THEN regexp_replace(url, '^([a-z]+://[^/?#]*)', '\\1//verify-login%2F')
  WHEN 5 THEN replace(url, '.example.', '.my-example' || (page_id % 10)::VARCHAR || '.') WHEN 6 THEN regexp_replace(url, '^([a-z]+://[^/?#]*)', '\\1:' || CASE WHEN page_id % 16 = 6 THEN '8080' ELSE '99999' END)
  WHEN 7 THEN regexp_replace(url, '^[a-z]+://', '') ELSE url END"""

#: Password fields on some of them, and redirections and a labelled input on others.
ODD_HTML = """html || CASE WHEN page_id % 8 IN (1, 4) OR page_id % 11 = 0 THEN '<form><INPUT class=x type="password"></form>' ELSE '' END || CASE WHEN page_id % 6 = 0 THEN '<meta content="0" http-equiv=''refresh''>' ELSE '' END
  || CASE WHEN page_id % 9 = 0 THEN '<input type="hidden" value=" Verify  Now "><button>Log
 in</button>' ELSE '' END"""

#: A table expression of the pages so changed, for DuckDB.
ODD_PAGES = f"(SELECT page_id, {ODD_URL} AS url, {ODD_HTML} AS html FROM pages)"


def odd_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) as in ``ODD_PAGES``."""
    p, url = F.col("page_id"), F.col("url")
    k = p % 8
    scheme, rest = F.regexp_extract(url, r"^([a-z]+)://", 1), F.regexp_replace(url, r"^[a-z]+://[^/?#]*", "")
    authority = F.regexp_extract(url, r"^[a-z]+://([^/?#]*)", 1)
    after_authority = lambda more: F.concat(scheme, F.lit("://"), authority, more, rest)
    made = (
        F.when(k == 1, F.concat(scheme, F.lit("://10.0."), (p % 200).cast("string"), F.lit(".7"), rest))
        .when(k == 2, F.replace(url, F.lit("://"), F.lit("://xn--")))
        .when(k == 3, F.replace(url, F.lit("://"), F.concat(F.lit("://user"), p.cast("string"), F.lit("@"))))
        .when(k == 4, after_authority(F.lit("//verify-login%2F")))
        .when(k == 5, F.replace(url, F.lit(".example."), F.concat(F.lit(".my-example"), (p % 10).cast("string"), F.lit("."))))
        .when(k == 6, after_authority(F.when(p % 16 == 6, ":8080").otherwise(":99999")))
        .when(k == 7, F.regexp_replace(url, "^[a-z]+://", ""))
        .otherwise(url)
    )
    html = F.concat(
        F.col("html"),
        F.when(k.isin(1, 4) | (p % 11 == 0), '<form><INPUT class=x type="password"></form>').otherwise(""),
        F.when(p % 6 == 0, "<meta content=\"0\" http-equiv='refresh'>").otherwise(""),
        F.when(p % 9 == 0, '<input type="hidden" value=" Verify  Now "><button>Log\n in</button>').otherwise(""),
    )
    return pages.select("page_id", made.alias("url"), html.alias("html"))
