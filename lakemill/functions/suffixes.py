"""Public suffixes: rules with wildcards and exceptions, compiled from a trie of reversed labels into one expression.

A rule is a suffix (``co.uk``), a suffix below which every label is one (``*.ck``), or an exception to that (``!www.ck``), as in
the public list's format. Of the rules that a host matches an exception wins, then the longest; a host that matches none has its last
label as suffix. The expression looks whole suffixes up in hash sets, one for each number of labels, inside the JVM and without a join.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rules that an expression may hold; the public list has about 10,000.
MOST_RULES = 50_000

# Suffixes of several labels that are common, wildcards and their exceptions. Pass the whole list where it is at hand.
COMMON_RULES = (
    "co.uk", "org.uk", "me.uk", "ltd.uk", "plc.uk", "net.uk", "ac.uk", "gov.uk", "nhs.uk", "police.uk", "*.sch.uk",
    "com.au", "net.au", "org.au", "edu.au", "gov.au", "asn.au", "id.au",
    "co.nz", "net.nz", "org.nz", "ac.nz", "govt.nz", "school.nz",
    "co.za", "net.za", "org.za", "ac.za", "gov.za", "web.za",
    "co.jp", "ne.jp", "or.jp", "ac.jp", "ad.jp", "ed.jp", "go.jp", "gr.jp", "lg.jp",
    "*.kawasaki.jp", "!city.kawasaki.jp", "*.kitakyushu.jp", "!city.kitakyushu.jp", "*.kobe.jp", "!city.kobe.jp", "*.nagoya.jp", "!city.nagoya.jp",
    "*.sapporo.jp", "!city.sapporo.jp", "*.sendai.jp", "!city.sendai.jp", "*.yokohama.jp", "!city.yokohama.jp",
    "co.kr", "ne.kr", "or.kr", "ac.kr", "go.kr", "re.kr",
    "com.cn", "net.cn", "org.cn", "edu.cn", "gov.cn", "ac.cn",
    "com.tw", "net.tw", "org.tw", "edu.tw", "gov.tw", "com.hk", "net.hk", "org.hk", "edu.hk", "gov.hk",
    "com.sg", "net.sg", "org.sg", "edu.sg", "gov.sg", "com.my", "net.my", "org.my", "edu.my", "gov.my",
    "co.in", "net.in", "org.in", "firm.in", "gen.in", "ind.in", "ac.in", "edu.in", "gov.in", "nic.in",
    "co.id", "or.id", "ac.id", "go.id", "web.id", "co.th", "or.th", "ac.th", "go.th", "in.th",
    "com.br", "net.br", "org.br", "edu.br", "gov.br", "com.mx", "org.mx", "edu.mx", "gob.mx", "com.ar", "net.ar", "org.ar", "edu.ar", "gob.ar",
    "com.co", "net.co", "org.co", "edu.co", "gov.co", "com.tr", "net.tr", "org.tr", "edu.tr", "gov.tr",
    "co.il", "org.il", "ac.il", "gov.il", "com.ua", "net.ua", "org.ua", "edu.ua", "gov.ua", "com.pl", "net.pl", "org.pl", "edu.pl", "gov.pl",
    "*.ck", "!www.ck", "*.bd", "*.er", "*.fk", "*.jm", "*.kh", "*.mm", "*.np", "*.pg",
)


class SuffixRules:
    """A trie of reversed labels. A node's mark is None, ``exact`` or ``exception``; ``*`` is a label like others until it is looked up."""

    def __init__(self, rules: Iterable[str] = COMMON_RULES):
        self.root: dict = {}
        n = 0
        for rule in rules:
            for form in _forms(rule):
                n += self._add(form)
        if n > MOST_RULES:
            raise ValueError(f"{n} suffix rules; an expression holds {MOST_RULES}")

    @classmethod
    def parse(cls, lines: Iterable[str], private: bool = False) -> SuffixRules:
        """From lines of the public list's format; its private part counts only if asked for."""
        rules, skipped = [], False
        for line in lines:
            line = line.strip()
            if line.startswith("//"):
                skipped = False if "===END PRIVATE" in line else not private if "===BEGIN PRIVATE" in line else skipped
            elif line and not skipped:
                rules.append(line.split()[0])
        return cls(rules)

    def _add(self, rule: str) -> int:
        mark, labels = ("exception", rule[1:]) if rule.startswith("!") else ("exact", rule)
        node = self.root
        for label in reversed(labels.split(".")):
            node = node.setdefault(label, {})
        fresh = None not in node
        node[None] = mark
        return fresh

    @cached_property
    def levels(self) -> list[tuple[list[str], list[str], list[str]]]:
        """For each number of labels: suffixes, what stands behind a ``*``, and exceptions."""
        found: list[tuple[list[str], list[str], list[str]]] = []

        def walk(node: dict, labels: list[str]):
            for label, below in sorted(node.items(), key=lambda x: x[0] or ""):
                if label is None:
                    while len(found) < len(labels):
                        found.append(([], [], []))
                    at = found[len(labels) - 1]
                    name = ".".join(reversed(labels))
                    if below == "exception":
                        at[2].append(name)
                    elif labels[-1] == "*":
                        at[1].append(name[2:])
                    else:
                        at[0].append(name)
                else:
                    walk(below, [*labels, label])

        walk(self.root, [])
        return found

    def labels_of_suffix(self, labels: str) -> Column:
        """How many labels of the array column ``labels`` are its public suffix; 1 where no rule matches."""
        exceptions, matches = [], ["1"]
        for k, (exact, wild, excepted) in enumerate(self.levels, 1):
            n, tail = f"size({labels})", lambda m: f"concat_ws('.', slice({labels}, greatest(size({labels}) - {m - 1}, 1), {m}))"
            if excepted:
                exceptions.append(f"CASE WHEN {n} >= {k} AND {tail(k)} IN ({_listed(excepted)}) THEN {k - 1} END")
            if exact:
                matches.append(f"CASE WHEN {n} >= {k} AND {tail(k)} IN ({_listed(exact)}) THEN {k} END")
            if wild:
                matches.append(f"CASE WHEN {n} >= {k} AND {tail(k - 1) if k > 1 else repr('')} IN ({_listed(wild)}) THEN {k} END")
        longest = f"greatest({', '.join(matches)}, 1)"
        return F.expr(f"coalesce({', '.join([*exceptions, longest])})")


def _listed(names: list[str]) -> str:
    return ", ".join("'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for n in names)


def _forms(rule: str) -> set[str]:
    """A rule in lower case, and as hosts write it if it is not ASCII."""
    rule = rule.strip().lower().strip(".")
    if rule.isascii():
        return {rule}
    mark, name = ("!", rule[1:]) if rule.startswith("!") else ("", rule)
    return {rule, mark + ".".join(x if x == "*" else x.encode("idna").decode() for x in name.split("."))}


COMMON = SuffixRules()
