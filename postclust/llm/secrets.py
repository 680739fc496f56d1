"""Operator 6, secret scans through a trigram index.

From each rule's regular expression follows a Boolean query: an OR over the
alternatives that it can begin or go on with, of the AND of the trigrams that
each makes mandatory, in lower case. The postings of those trigrams (trigram,
document) are intersected by counting, for each document and alternative, how
many of its trigrams are there; the rule's expression then runs on the documents
that are left. A rule without mandatory trigrams runs on all of them.

Spans are code points, end exclusive. Positions follow from the lengths of the
matches and of what the same expression leaves between them.

Edge cases: a null or empty text has no spans; a row without ``doc_id`` is
verified whatever the index says, and rows that share one are verified if any of
them is a candidate; each row has its own spans, copies too; an empty table
gives an empty result; other columns are ignored.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postclust.llm.common import materialize, may_broadcast


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str      # leftmost matches that do not overlap
    group: int        # whose length decides whether a match counts
    least: int        # its least length


# The base kinds in the order in which they are listed. A run of
# one class is matched whole or not at all, so its least length stands in the
# pattern; the length of a value after an assignment is asked for afterwards.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)

#: Alternatives followed when a query is derived; beyond them the rule scans all.
MAX_ALTERNATIVES = 256


def literal_runs(items) -> list[list[str]] | None:
    """The alternatives of a parsed expression, each as the runs of characters that
    any match of it holds; a run goes on only while nothing else can stand between."""
    found = [[""]]
    for op, arg in items:
        if op is sre.LITERAL:
            step = [[chr(arg)]]
        elif op is sre.SUBPATTERN:
            step = literal_runs(arg[3])
        elif op is sre.BRANCH:
            parts = [literal_runs(p) for p in arg[1]]
            step = None if None in parts else [a for p in parts for a in p]
        elif op is sre.MAX_REPEAT and arg[:2] == (0, 1) and len(arg[2]) == 1 and arg[2][0][0] is sre.LITERAL:
            step = [[""], [chr(arg[2][0][1])]]
        else:
            step = [["", ""]]  # anything: the run ends here and a new one begins
        if step is None or len(found) * len(step) > MAX_ALTERNATIVES:
            return None
        # the last run so far and the first of the step are one
        found = [[*a[:-1], a[-1] + b[0], *b[1:]] for a in found for b in step]
    return found


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """OR over sets of trigrams that must all be there; empty: scan all."""
    runs = literal_runs(parser.parse(pattern))
    sets = [frozenset(r[i:i + 3].lower() for r in rs for i in range(len(r) - 2)) for rs in runs or []]
    return [] if not all(sets) else sorted(set(sets), key=sorted)


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """``(trigram, doc_id)`` of the trigrams that the rules ask for."""
    low = F.lower("text")
    held = F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in trigrams])
    return docs.where("doc_id is not null").select(
        F.explode(F.array_compact(held)).alias("trigram"), "doc_id").distinct()


def candidates(docs: DataFrame, rules=RULES) -> DataFrame:
    """``(doc_id, rules)``: the indexed rules whose query a document satisfies."""
    asks = [(r.name, i, t, len(alt)) for r in rules for i, alt in enumerate(trigram_query(r.pattern)) for t in alt]
    query = docs.sparkSession.createDataFrame(asks, "rule string, alternative int, trigram string, need int")
    index = postings(docs, sorted({t for _, _, t, _ in asks}))
    met = index.join(F.broadcast(query), "trigram").groupBy("doc_id", "rule", "alternative", "need").count()
    return met.where("count = need").groupBy("doc_id").agg(F.collect_set("rule").alias("rules"))


def rule_spans(rule: Rule, order: int, text: Column) -> Column:
    """The rule's spans in a text: array of (start, order, end, kind)."""
    pattern = F.lit(rule.pattern)
    matches = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
    )
    kind = "struct<start:int,kind_order:int,end:int,kind:string>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("spans"))

    def step(acc: Column, m: Column) -> Column:
        begin = acc["at"] + F.length(m["gap"])
        end = begin + F.coalesce(F.length(m["hit"]), F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(order).alias("kind_order"), end.alias("end"), F.lit(rule.name).alias("kind"))
        counts = F.coalesce(F.length(m["value"]) >= rule.least, F.lit(False))
        spans = F.when(counts, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(matches, start, step, lambda acc: acc["spans"])


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """``(doc_id, spans)`` of every row: ``(start, kind_order, end, kind)`` by start, then kind."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    listed = materialize(candidates(rows, rules), "candidates")
    if may_broadcast(listed):
        listed = F.broadcast(listed)
    rows = rows.join(listed, "doc_id", "left")
    none = F.array().cast("array<struct<start:int,kind_order:int,end:int,kind:string>>")
    spans = []
    for i, rule in enumerate(rules):
        chosen = F.rlike("text", F.lit(rule.pattern))
        if trigram_query(rule.pattern):
            chosen = (F.col("doc_id").isNull() | F.coalesce(F.array_contains("rules", rule.name), F.lit(False))) & chosen
        spans.append(F.when(chosen, rule_spans(rule, i, F.col("text"))).otherwise(none))
    return rows.select("doc_id", F.array_sort(F.concat(*spans)).alias("spans"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
