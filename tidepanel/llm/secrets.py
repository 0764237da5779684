"""Secret scans behind a trigram index.

From each rule's pattern a Boolean query over trigrams is derived: every match must hold all
trigrams of one of the query's clauses. The postings of those trigrams, pairs of trigram and
document, are collected once; intersecting them per clause leaves the documents that can
match, and only those are searched with the pattern. A pattern without mandatory trigrams
searches every document.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import is_few, only, small_table
from tidepanel.session import materialise


@dataclass(frozen=True)
class Rule:
    """A pattern, and the least length of one of its groups for a match to count."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The patterns and lengths of the contract. A run of one class of characters is
#: matched whole, so its least length can stand in the pattern.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: Published token formats.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{15,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE
_ALTERNATIVES = 64
_SMALL_CLASS = 8


def _literals(tree) -> list[list[str]]:
    """The alternatives of a parsed pattern, each as the literal runs that it must contain.
    An empty run marks a gap between runs."""
    found: list[list[str]] = [[""]]
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            own = [[chr(arg).lower()]]
        elif name == "SUBPATTERN":
            own = _literals(arg[-1])
        elif name == "BRANCH":
            own = [x for branch in arg[1] for x in _literals(branch)]
        elif name == "IN" and len(arg) <= _SMALL_CLASS and all(str(o) == "LITERAL" for o, _ in arg):
            own = [[c] for c in sorted({chr(v).lower() for _, v in arg})]
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] == 1:
            own = _literals(arg[2]) + ([[""]] if arg[0] == 0 else [])
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] > 0:
            own = [x + ["", ""] for x in _literals(arg[2])]
        else:
            own = [["", ""]]
        if len(found) * len(own) > _ALTERNATIVES:
            own = [["", ""]]
        found = [left[:-1] + [left[-1] + right[0]] + right[1:] for left in found for right in own]
    return found


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses of lower-case trigrams; each match holds all of one clause. No clauses when a
    match may hold no trigram at all."""
    clauses = {frozenset(run[i:i + 3] for run in runs for i in range(len(run) - 2))
               for runs in _literals(re._parser.parse(pattern))}
    if frozenset() in clauses:
        return []
    return sorted((c for c in clauses if not any(o < c for o in clauses)), key=sorted)


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id) for each of ``trigrams`` that a text holds, in any case of letters."""
    folded = F.array(F.lower(F.coalesce(F.col("text"), F.lit(""))))
    held = F.transform(folded, lambda s: F.array_compact(
        F.array(*[F.when(F.contains(s, F.lit(t)), F.lit(t)) for t in trigrams])))
    return docs.select("doc_id", F.explode(F.element_at(held, 1)).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, rules): the rules, as bits, that a document may match by its postings."""
    terms = []
    for r, rule in enumerate(rules):
        for c, clause in enumerate(trigram_query(rule.pattern)):
            terms += [{"trigram": t, "rule": r, "clause": c, "bit": 1 << i, "whole": (1 << len(clause)) - 1}
                      for i, t in enumerate(sorted(clause))]
    table = small_table(index.sparkSession, terms,
                        "trigram string, rule int, clause int, bit long, whole long")
    met = (index.join(F.broadcast(table), "trigram")
           .groupBy("doc_id", "rule", "clause", "whole").agg(F.bit_or("bit").alias("held"))
           .where("held = whole"))
    return met.groupBy("doc_id").agg(F.bit_or(F.expr("shiftleft(1, rule)")).alias("rules"))


def rule_spans(text: Column, rule: Rule, number: int) -> Column:
    """Start, rule number, end and kind of a rule's matches, leftmost and not overlapping."""
    p = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, p, 0)
    parts = F.arrays_zip(matches.alias("m"), F.regexp_extract_all(text, p, rule.group).alias("g"),
                         F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(matches)).alias("gap"))
    kind = "array<struct<start:int,number:int,end:int,kind:string>>"
    first = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["m"])
        one = F.struct(start.alias("start"), F.lit(number).alias("number"), end.alias("end"),
                       F.lit(rule.kind).alias("kind"))
        return F.struct(end.alias("at"), F.when(F.length(x["g"]) >= rule.least,
                                                F.concat(acc["found"], F.array(one)))
                        .otherwise(acc["found"]).alias("found"))

    return F.when(F.regexp_like(text, p), F.aggregate(parts, first, step, lambda a: a["found"])
                  ).otherwise(F.array().cast(kind))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with a column ``spans``: start, end (code points, end exclusive) and kind of
    every match, by start and order of the rules.

    Null text has no spans. Documents that share an id, or have none, share their candidate
    rules, which only widens the search; each row keeps its own spans. A column ``spans`` of
    the input is replaced, other columns stay. Candidates travel to the texts when a count
    shows that they are few, else both sides are shuffled.
    """
    queries = {r: trigram_query(rule.pattern) for r, rule in enumerate(rules)}
    trigrams = sorted({t for clauses in queries.values() for c in clauses for t in c})
    others = [c for c in docs.columns if c not in ("doc_id", "text", "spans")]
    rows = docs.select("doc_id", "text", F.struct(F.lit(0).alias("no_column"), *others).alias("rest"))
    if trigrams:
        found = materialise(candidates(postings(only(docs, "doc_id", "text"), trigrams), rules), "candidates")
        found = found.select(F.col("doc_id").alias("c_id"), "rules")
        rows = rows.join(F.broadcast(found) if is_few(found) else found,
                         F.col("doc_id").eqNullSafe(F.col("c_id")), "left").drop("c_id")
    else:
        rows = rows.withColumn("rules", F.lit(0))
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = []
    for r, rule in enumerate(rules):
        own = rule_spans(text, rule, r)
        may = F.coalesce(F.col("rules"), F.lit(0)).bitwiseAND(1 << r) > 0
        parts.append(F.when(may, own).otherwise(F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>"))
                     if queries[r] else own)
    rows = rows.withColumn("spans", F.array_sort(F.concat(*parts)))
    return rows.select(*[F.col("rest")[c].alias(c) if c in others else F.col(c)
                         for c in docs.columns if c != "spans"], "spans")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each span, or run of overlapping spans, replaced by ``mark``."""
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        apart = x["start"] >= acc["at"]
        kept = F.substring(text, acc["at"] + 1, x["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"),
                        F.when(apart, F.concat(acc["out"], kept, F.lit(mark)))
                        .otherwise(acc["out"]).alias("out"))

    rest = lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, first, step, rest)).otherwise(text)
