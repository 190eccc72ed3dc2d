"""Secret scans by a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression. From it a Boolean trigram query is derived
(after Cox, "Regular Expression Matching with a Trigram Index"): the literal
strings that a match must contain, as alternatives of trigrams that all must
occur. The index has postings (trigram, row) for the trigrams of these queries;
intersecting the postings of an alternative gives the rule's candidate rows,
which the regular expression then verifies. A rule without a mandatory
trigram (hex runs) scans every row.

Postings, their intersection (a bitwise or, combined before the shuffle) and
the join with the rows are keyed by a 128-bit key of the whole row, so no
source or group of copies makes a hot key.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, named, row_key, unboxed


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more.

    The pattern is read alike by Java and Python and matches no empty text.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules. A run of hex digits is matched whole, so 24 or more is part of its pattern.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Further public token formats.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE

# Literal strings enumerated at once, and trigrams of one alternative (bits of a long).
MOST_STRINGS, MOST_TRIGRAMS = 32, 62

SPANS = "array<struct<start:int,order:int,end:int,kept:int>>"

Query = list[frozenset[str]]


def trigram_query(pattern: str) -> Query:
    """Alternatives (any may hold) of lower-case trigrams (all must occur); empty: no mandatory trigram."""
    query = _demanded(_parser.parse(pattern))
    if not all(query):
        return []
    return [frozenset(sorted(clause)[:MOST_TRIGRAMS]) for clause in query]


def _demanded(nodes) -> Query:
    """The trigram query of a sequence of regex nodes; an empty alternative demands nothing."""
    strings, query = {""}, [frozenset()]
    for kind, value in nodes:
        options = _strings([(kind, value)])
        grown = {a + b for a, b in product(strings, options)} if options else set()
        if options and len(grown) <= MOST_STRINGS:
            strings = grown
            continue
        query = _both(query, _trigrams(strings))
        strings = options or {""}
        if options is None and kind is sre.SUBPATTERN:
            query = _both(query, _demanded(value[-1]))
        elif options is None and kind is sre.MAX_REPEAT and value[0] > 0:
            query = _both(query, _demanded(value[2]))
        elif options is None and kind is sre.BRANCH:
            query = _both(query, [clause for branch in value[1] for clause in _demanded(branch)])
    return _both(query, _trigrams(strings))


def _strings(nodes) -> set[str] | None:
    """All strings (lower-case) that the nodes match, if they are few."""
    out = {""}
    for kind, value in nodes:
        if kind is sre.LITERAL and value < 128:
            options = {chr(value).lower()}
        elif kind is sre.IN:
            options = _characters(value)
        elif kind is sre.SUBPATTERN:
            options = _strings(value[-1])
        elif kind is sre.BRANCH:
            parts = [_strings(branch) for branch in value[1]]
            options = None if None in parts else set().union(*parts)
        elif kind is sre.MAX_REPEAT and value[1] == 1:
            inner = _strings(value[2])
            options = inner if inner is None or value[0] else inner | {""}
        else:
            options = None
        if options is None or len(out) * len(options) > MOST_STRINGS:
            return None
        out = {a + b for a, b in product(out, options)}
    return out


def _characters(items) -> set[str] | None:
    out: set[str] = set()
    for kind, value in items:
        if kind is not sre.LITERAL or value >= 128:
            return None
        out.add(chr(value).lower())
    return out


def _trigrams(strings: set[str]) -> Query:
    return [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings]


def _both(a: Query, b: Query) -> Query:
    """Both queries hold; alternatives that another one implies are left out."""
    merged = {x | y for x, y in product(a, b)}
    return [c for c in merged if not any(d < c for d in merged)]


def _clauses(rules: tuple[Rule, ...]) -> list[tuple[int, int, str, int, int]]:
    """(bit of the rule, clause number, trigram, its bit, all bits of the clause)."""
    out, number = [], 0
    for r, rule in enumerate(rules):
        for clause in sorted(map(sorted, trigram_query(rule.pattern))):
            whole = (1 << len(clause)) - 1
            out += [(1 << r, number, gram, 1 << i, whole) for i, gram in enumerate(clause)]
            number += 1
    return out


def postings(rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(gram, key): the index of the rules' trigrams over ``rows`` (key, text)."""
    grams = sorted({c[2] for c in _clauses(rules)})
    low = rows.select("key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return low.select("key", F.explode(held).alias("gram"))


def candidates(rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, rules): bits of the rules of which some alternative has all its trigrams in the row."""
    clauses = rows.sparkSession.createDataFrame(_clauses(rules), "rule long, clause int, gram string, bit long, whole long")
    return (postings(rows, rules).join(F.broadcast(clauses), "gram")  # as many rows as the rules have trigrams
            .groupBy("key", "rule", "clause", "whole").agg(F.bit_or("bit").alias("seen"))
            .where("seen = whole")
            .groupBy("key").agg(F.bit_or("rule").alias("rules")))


# Elements of an array that one walk goes through; longer arrays are walked in pieces of
# this size and then piece by piece, so the copies that a growing array costs stay few.
PIECE = 128


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of the value, which is worked out once, however often it is used within."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _pieces(array: Column) -> Column:
    """The array, a bound value, in pieces of ``PIECE`` elements."""
    n = F.size(array)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / PIECE).cast("int")),
                                     lambda i: F.slice(array, i * PIECE + 1, F.lit(PIECE)))).otherwise(
        F.slice(F.array(array), 2, 1))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans (start, order, end) of the rule's matches, in code points: the text is
    cut at the matches, and pieces and matches are measured in turn."""
    pattern = F.lit(rule.pattern)
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)

    def measured(matches: Column) -> Column:
        arrays = (F.slice(gaps, F.lit(1), F.size(matches)), matches, kept)
        return F.arrays_zip(*[F.transform(a, F.length) for a in arrays]).cast("array<struct<gap:int,own:int,kept:int>>")

    rows = _let(F.regexp_extract_all(text, pattern, F.lit(0)), measured)
    empty = F.array().cast(SPANS)

    def walked(piece: Column) -> Column:
        """Where the piece ends and its spans, counted from its own begin."""
        return F.aggregate(
            piece, F.struct(F.lit(0).alias("at"), empty.alias("spans")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + x["own"]).alias("at"),
                F.array_append(acc["spans"], F.struct(
                    (acc["at"] + x["gap"]).alias("start"), F.lit(order).alias("order"),
                    (acc["at"] + x["gap"] + x["own"]).alias("end"), x["kept"].alias("kept"))).alias("spans")))

    def moved(spans: Column, by: Column) -> Column:
        return F.transform(spans, lambda s: F.struct((s["start"] + by).alias("start"), s["order"].alias("order"),
                                                     (s["end"] + by).alias("end"), s["kept"].alias("kept")))

    placed = F.aggregate(
        _let(rows, lambda r: F.transform(_pieces(r), walked)),
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("spans")),
        lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"),
                                F.array_append(acc["spans"], moved(x["spans"], acc["at"])).alias("spans")),
        lambda acc: F.flatten(acc["spans"]))
    return F.filter(placed, lambda s: s["kept"] >= rule.least)


def _found(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc, secrets): each row of ``docs`` in a struct, and its spans."""
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    rows = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), boxed(docs))
    indexed = [bool(trigram_query(r.pattern)) for r in rules]
    found = candidates(rows.select("key", F.col("doc.text").alias("text")), rules)
    joined = rows.join(found, "key", "left")
    none = F.array().cast(SPANS)
    per_rule = []
    for i, rule in enumerate(rules):
        asked = ((F.coalesce("rules", F.lit(0)).bitwiseAND(F.lit(1 << i)) != 0) if indexed[i] else F.lit(True))
        per_rule.append(F.when(asked & text.rlike(rule.pattern), _spans(text, rule, i)).otherwise(none))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    spans = F.transform(F.array_sort(F.concat(*per_rule)),
                        lambda s: F.struct(s["start"].alias("start"), F.get(kinds, s["order"]).alias("kind"),
                                           s["end"].alias("end")))
    return joined.select("doc", spans.alias("secrets"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``secrets``: array of (start, kind, end), by start, then kind as listed.

    ``start`` and ``end`` (exclusive) count code points. Null and empty texts
    have no spans; every row is returned once, repeated rows included; an empty
    table gives no rows, and texts of any length are scanned as a whole. A
    column named ``secrets`` is replaced; others stay, whatever their names.
    """
    kept = docs.select(*[named(c) for c in docs.columns if c != "secrets"])
    return _found(kept, rules).select(*unboxed(kept), "secrets")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _cuts(spans: Column) -> Column:
    """(start, end, fresh) of the stretches that the sorted spans cover, in order and apart.

    ``fresh`` is false for one that only goes on with the one before it.
    """
    cut = "array<struct<start:int,end:int,fresh:boolean>>"

    def add(acc: Column, s: Column) -> Column:
        own = F.struct(F.greatest(s["start"], acc["at"]).alias("start"), s["end"].alias("end"),
                       (s["start"] >= acc["at"]).alias("fresh"))
        return F.when(s["end"] <= acc["at"], acc).otherwise(
            F.struct(s["end"].alias("at"), F.array_append(acc["cuts"], own).alias("cuts")))

    def within(piece: Column, at: Column) -> Column:
        return F.aggregate(piece, F.struct(at.alias("at"), F.array().cast(cut).alias("cuts")), add)

    def piecewise(acc: Column, piece: Column) -> Column:
        return _let(within(piece, acc["at"]), lambda own: F.struct(
            own["at"].alias("at"), F.array_append(acc["cuts"], own["cuts"]).alias("cuts")))

    return F.aggregate(_let(spans, _pieces), F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{cut}>").alias("cuts")),
                       piecewise, lambda acc: F.flatten(acc["cuts"]))


def _without(text: Column, cuts: Column, mark: str) -> Column:
    """The text with each fresh cut replaced by the mark, others by nothing.

    The text is first cut into stretches of ``PIECE`` cuts each, then these at
    their cuts, so no cut is looked for from the text's begin.
    """
    def stretch(begin: Column, g: Column) -> Column:
        return _let(F.substring(text, begin + 1, F.element_at(g, -1)["end"] - begin), lambda own: _let(
            F.concat(F.array(begin), F.transform(g, lambda c: c["end"])), lambda ends: F.array_join(F.transform(
                g, lambda c, k: F.concat(
                    F.substring(own, F.get(ends, k) - begin + 1, c["start"] - F.get(ends, k)),
                    F.when(c["fresh"], F.lit(mark)).otherwise(F.lit("")))), "")))

    def whole(groups: Column, begins: Column) -> Column:
        rest = F.substring(text, F.get(begins, F.size(groups)) + 1, F.length(text))
        return F.concat(F.array_join(F.transform(groups, lambda g, i: stretch(F.get(begins, i), g)), ""), rest)

    return _let(_let(cuts, _pieces), lambda groups: _let(
        F.concat(F.array(F.lit(0)), F.transform(groups, lambda g: F.element_at(g, -1)["end"])),
        lambda begins: whole(groups, begins)))


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """``docs`` with each run of overlapping spans of the text replaced by ``mark``; all columns kept.

    ``n_chars``, where there is one, becomes the length of a changed text.
    Texts without spans stay as they are, null ones too; repeated rows stay
    repeated, an empty table empty, and columns of any name as they are.
    """
    found = _found(docs, rules)
    changed = F.size("secrets") > 0
    new = F.when(changed, _without(F.col("doc.text"), _cuts(F.col("secrets")), mark)).otherwise(F.col("doc.text"))
    rows = found.select("doc", new.alias("new"), changed.alias("changed"))
    columns = [F.col("new").alias("text") if n == "text" else
               F.when(F.col("changed"), F.length("new")).otherwise(named(n, "doc")).cast(docs.schema[n].dataType).alias(n)
               if n == "n_chars" else named(n, "doc").alias(n) for n in docs.columns]
    return rows.select(*columns)


def _oracle() -> str:
    """The same spans in DuckDB: texts cut at the matches of every rule, lengths summed."""
    def rule_rows(i: int, rule: Rule) -> str:
        pattern = rule.pattern.replace("'", "''")
        return f"""SELECT r, {i} AS o, '{rule.kind}' AS kind, {rule.least} AS least,
          string_split_regex(t, '{pattern}') AS pieces, regexp_extract_all(t, '{pattern}', 0) AS own,
          regexp_extract_all(t, '{pattern}', {rule.group}) AS kept FROM docs WHERE regexp_matches(t, '{pattern}')"""

    rows = " UNION ALL ".join(rule_rows(i, rule) for i, rule in enumerate(RULES))
    base = len(BASE)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
cut AS ({rows}),
each AS (SELECT r, o, kind, least, pieces, own, kept, unnest(range(1, len(own) + 1)) AS i FROM cut),
spans AS (
  SELECT r, o, kind, length(kept[i]) AS n, length(own[i]) AS size,
    length(array_to_string(pieces[1:i], '')) + length(array_to_string(own[1:i - 1], '')) AS s, least FROM each),
good AS (SELECT *, kind || ':' || s || ':' || (s + size) AS txt FROM spans WHERE n >= least),
one AS (
  SELECT r, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
    string_agg(txt, ',' ORDER BY s, o) FILTER (o < {base}) AS base, string_agg(txt, ',' ORDER BY s, o) AS spans
  FROM good GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN one USING (r)
"""


ORACLE = _oracle()
