"""Registrable domains by the public suffix rules.

The rules are literals of the plan, and a host is tested against them inside its own row: no join, no shuffle and no
Python.  The rule file is a parameter, since the list changes; a file that is absent is an error, not another result.
"""

from __future__ import annotations

import os
import zlib
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

RULE_FILE = os.environ.get("LINKLOOM_SUFFIX_RULES", "/usr/share/publicsuffix/public_suffix_list.dat")
# Suffixes that are used if the rule file is set to `common`.
COMMON = tuple("com net org edu gov info biz io co me tv de fr es it nl pl ru eu uk co.uk org.uk ac.uk jp co.jp ne.jp com.au com.br com.tr com.tw co.in co.nz co.kr cn com.cn blogspot.com".split())


@dataclass(frozen=True)
class SuffixRules:
    plain: tuple[str, ...]
    wildcard: tuple[str, ...] = ()
    exception: tuple[str, ...] = ()

    @classmethod
    def parse(cls, text: str) -> SuffixRules:
        lines = [x.split()[0].lower() for x in text.splitlines() if x.strip() and not x.startswith("//")]
        lines += [x.encode("idna").decode() for x in lines if not x.isascii() and not x.startswith(("*", "!"))]
        return cls(tuple(x for x in lines if x[0] not in "*!"), tuple(x[2:] for x in lines if x.startswith("*.")), tuple(x[1:] for x in lines if x.startswith("!")))


@lru_cache(maxsize=8)
def load_rules(path: str | None = None) -> SuffixRules:
    path = path or RULE_FILE
    if path == "common":
        return SuffixRules(COMMON)
    if not os.path.exists(path):
        raise FileNotFoundError(f"no public suffix list at {path}: set LINKLOOM_SUFFIX_RULES to one, or to `common` for a short list")
    with open(path, encoding="utf-8") as f:
        return SuffixRules.parse(f.read())


#: Lists of names longer than this are tested through hash buckets.
FEW = 200


@lru_cache(maxsize=8)
def _buckets(names: tuple[str, ...]) -> tuple[str, int]:
    """An array of hash buckets, each a string ",a,b,", as SQL, and their number.

    The array is folded into one constant; a list of as many literals would be walked through by every rule of the optimizer.
    """
    n = 1 << len(names).bit_length()
    held: list[list[str]] = [[] for _ in range(n)]
    for name in dict.fromkeys(names):
        held[zlib.crc32(name.encode()) % n].append(name)
    text = ";".join("," + ",".join(x) + "," for x in held)
    return f"split('{text}', ';')", n


def _among(tail: str, names: tuple[str, ...]) -> str:
    if len(names) <= FEW:
        return f"{tail} IN ({', '.join(repr(n) for n in names)})" if names else "false"
    buckets, n = _buckets(names)
    return f"contains({buckets}[CAST(crc32(CAST({tail} AS BINARY)) % {n} AS INT)], concat(',', {tail}, ','))"


@lru_cache(maxsize=8)
def _suffix_length(rules: SuffixRules) -> str:
    """The number of labels of a host's public suffix; {host} and {n}, its number of labels, are put in.  Each rule stands in it once."""
    tail = "substring_index({host}, '.', -k)"
    most = lambda names, more: "coalesce(array_max(filter(sequence(1, {n}), k -> " + _among(tail, names) + f")), {1 - more}) + {more}"
    other = "array_max(filter(sequence(1, {n}), k -> " + _among(tail, rules.exception) + ")) - 1"
    wild = most(rules.wildcard, 1).replace("sequence(1, {n})", "slice(sequence(1, {n}), 1, {n} - 1)")
    return f"coalesce({other}, greatest({most(rules.plain, 0)}, {wild}))"


def registrable_domain_sql(host: str, rules: SuffixRules | None = None) -> str:
    """The registrable domain of a host, both SQL expressions; null if the host is a suffix itself or has an empty label.

    The longest matching rule counts, an exception before all others; without a match the last label is the suffix.
    """
    n = f"(length({host}) - length(replace({host}, '.', '')) + 1)"
    suffix = _suffix_length(rules or load_rules()).replace("{host}", host).replace("{n}", n)
    cut = f"transform(array({suffix}), s -> CASE WHEN {n} > s THEN substring_index({host}, '.', -(s + 1)) END)[0]"
    return f"CASE WHEN {host} <> '' AND NOT {host} RLIKE '^[.]|[.][.]|[.]$' THEN {cut} END"


def registrable_domain(host: str, rules: SuffixRules | None = None) -> Column:
    return F.expr(registrable_domain_sql(host, rules))
