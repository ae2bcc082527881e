"""Operator 9, secret scans over a trigram inverted index (DataFrame functions only).

For every rule a Boolean query over trigrams is derived from its regex: the
regex is walked with Python's own regex parser, literals multiply into exact
strings, alternatives add up, and what may be anything cuts the strings.  The
index holds a posting (trigram, document) for each trigram that some rule asks
for and that the lower-cased text contains.  Postings are intersected per
clause by counting, the clauses of a rule add up, and the candidates are
verified with the regex itself on the whole text.  Rules without a mandatory
trigram (runs of hex digits) scan every text.

Spans are code point offsets, end exclusive, leftmost and non-overlapping per
kind.  The three base kinds follow the contract; further kinds only add spans.

Defined results: a null or empty text has no spans; the digest of no spans is
that of the empty string.  Rows that repeat an id are scanned one by one, and a
null id is an id of its own.  An empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import re._parser as regex_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A clause is a set of trigrams that all must occur; a query is a list of clauses of which one must hold.
Query = list[frozenset[str]]


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    least: int = 0          # code points that the checked group must have
    group: int = 0          # the checked group


#: Fixed values of the contract, in its order.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    # Runs of 32 or more: shorter ones would be matched and dropped, which gives the same spans.
    Rule("hex", r"[0-9a-f]{32,}", 32),
)
#: Kinds that this scan adds.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

_MOST = 64          # exact strings a part may stand for before it is cut


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


class _Part:
    """What is known of the strings a part of a regex matches.

    ``open`` are the exact strings that may run on into the next part (lower
    case), each with the clause that the match so far implies."""

    def __init__(self, open_: list[tuple[str, frozenset[str]]]):
        self.open = open_

    def cut(self) -> "_Part":
        """After something unknown: keep what is implied, begin a new string."""
        return _Part(list(dict.fromkeys(("", c | _trigrams(s)) for s, c in self.open)))

    def then(self, other: list[tuple[str, frozenset[str]]]) -> "_Part":
        out = list(dict.fromkeys((s + t, c | d) for s, c in self.open for t, d in other))
        return _Part(out) if len(out) <= _MOST else self.cut()


def _walk(nodes, part: _Part) -> _Part:
    for op, arg in nodes:
        name = str(op)
        if name == "LITERAL":
            part = part.then([(chr(arg).lower(), frozenset())])
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg) and len(arg) <= 8:
            part = part.then([(chr(a).lower(), frozenset()) for _, a in arg])
        elif name == "SUBPATTERN":
            part = _walk(arg[-1], part)
        elif name == "BRANCH":
            part = _Part(list(dict.fromkeys(x for branch in arg[1] for x in _walk(branch, part).open)))
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, inner = arg
            if (low, high) == (0, 1):
                part = _Part(list(dict.fromkeys([*part.open, *_walk(inner, part).open])))
            elif low == 0:
                part = part.cut()
            else:
                part = _walk(inner, part)
                part = part if high == 1 else part.cut()
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            continue
        else:
            part = part.cut()
        if len(part.open) > _MOST:
            part = part.cut()
    return part


def trigram_query(regex: str) -> Query:
    """Clauses of lower-case trigrams, one of which every match contains whole; empty if there is none."""
    clauses = {c for _, c in _walk(regex_parser.parse(regex), _Part([("", frozenset())])).cut().open}
    if frozenset() in clauses:
        return []
    return sorted((c for c in clauses if not any(d < c for d in clauses)), key=sorted)


def _row_key(id_col: str, text_col: str) -> Column:
    """The id; rows without one are told apart by their text, so they are no hot key."""
    return F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null "), F.hex(F.xxhash64(text_col))))


def candidates(docs: DataFrame, rules: tuple[Rule, ...], id_col: str, text_col: str) -> DataFrame:
    """(key, rules): for each document the rules whose trigram query its postings satisfy."""
    clauses = [(r.kind, i, t, len(c)) for r in rules for i, c in enumerate(trigram_query(r.regex)) for t in sorted(c)]
    if not clauses:
        return docs.select(_row_key(id_col, text_col).alias("key"), F.array().cast("array<string>").alias("rules")).limit(0)
    lower = F.lower(F.col(text_col))
    asked = sorted({t for _, _, t, _ in clauses})
    postings = docs.select(_row_key(id_col, text_col).alias("key"), lower.alias("low")).select(
        "key", F.explode(F.array_compact(F.array(
            *[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in asked]))).alias("trigram"))
    wanted = docs.sparkSession.createDataFrame(clauses, "rule string, clause int, trigram string, size int")
    hits = (postings.join(F.broadcast(wanted), "trigram")       # a fixed table: the rules' own trigrams
            .groupBy("key", "rule", "clause", "size").agg(F.count_distinct("trigram").alias("n"))
            .where(F.col("n") == F.col("size")))
    return hits.groupBy("key").agg(F.collect_set("rule").alias("rules"))


def _spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, kind_no, kind, end>> of one rule's matches, from the pieces between them."""
    regex = F.lit(rule.regex)
    return F.struct(F.split(text, rule.regex, -1).alias("gaps"), F.regexp_extract_all(text, regex, 0).alias("hits"),
                    F.regexp_extract_all(text, regex, rule.group).alias("checked"))


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and ``spans``, an array of (start, no, kind, end) in text order."""
    full = [r for r in rules if not trigram_query(r.regex)]
    found = candidates(docs, tuple(r for r in rules if r not in full), id_col, text_col)
    rows = docs.select(F.col(id_col).alias("id"), _row_key(id_col, text_col).alias("key"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.join(found, "key", "left")
    # A rule that no candidate list names costs nothing; the others look at the whole text.
    for rule in rules:
        text = F.col("text")
        asked = text.rlike(rule.regex) if rule in full else \
            F.coalesce(F.array_contains("rules", rule.kind), F.lit(False)) & text.rlike(rule.regex)
        rows = rows.withColumn(f"raw_{rule.kind}", F.when(asked, _spans(text, rule)))
    rows = rows.drop("text", "rules", "key")
    for no, rule in enumerate(rules):
        raw = F.col(f"raw_{rule.kind}")
        parts = F.zip_with(F.zip_with(raw.gaps, raw.hits, lambda g, h: F.struct(
            F.char_length(g).alias("gap"), F.char_length(h).alias("len"))), raw.checked,
            lambda x, c: F.struct(x.gap.alias("gap"), x.len.alias("len"), F.char_length(c).alias("checked")))
        none = F.array().cast("array<struct<start:int,no:int,kind:string,end:int>>")
        step = lambda acc, x: F.struct(
            (acc.at + x.gap + F.coalesce(x.len, F.lit(0))).alias("at"),
            F.when(x.checked >= rule.least, F.concat(acc.got, F.array(F.struct(
                (acc.at + x.gap).alias("start"), F.lit(no).alias("no"), F.lit(rule.kind).alias("kind"),
                (acc.at + x.gap + x.len).alias("end"))))).otherwise(acc.got).alias("got"))
        rows = rows.withColumn(f"got_{rule.kind}", F.coalesce(F.aggregate(
            parts, F.struct(F.lit(0).alias("at"), none.alias("got")), step, lambda acc: acc.got), none))
    return rows.select("id", F.array_sort(F.concat(*[F.col(f"got_{r.kind}") for r in rules])).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))))


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's digest of the scan: counts, hash of the base spans, all spans."""
    found = scan_secrets(docs, RULES, id_col, text_col)
    base = F.filter("spans", lambda s: s.no < len(BASE_RULES))
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    return found.select(F.col("id").alias(id_col), *[count(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
