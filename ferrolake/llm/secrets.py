"""Secret scan with a trigram inverted index (operator 7, DataFrame functions only).

A Boolean query over trigrams is derived from each rule's regex: alternatives, each a set of trigrams that
any match must contain. Postings (trigram, document) are kept for the trigrams that occur in a query; an
alternative's postings are intersected by document, and only documents that satisfy an alternative of a rule
are verified with the rule's regex. Rules without mandatory trigrams are verified on every document.

The index folds case, so it proposes a superset for case-sensitive rules; verification decides. Postings of
one document are combined in its map task, so what is shuffled is one small row per document, rule and
alternative, and then the documents with their text once.

Defined results: null text counts as empty; positions are code points, ends exclusive; rows with equal
doc_id and text are reported one by one, as they stand; an empty table gives an empty result. Columns other than
doc_id and text are not read. Time per text is linear in its length for the regexes used here.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_key


@dataclass(frozen=True)
class Rule:
    """A match counts if its group ``group`` has ``least`` characters or more; others are consumed all the same."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1


# The base kinds in their order, then provider formats.
BASE = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
)
_SPAN = "array<struct<start:int,kind:int,end:int>>"
_MOST = 64  # alternatives followed at once; a part with more is left out of the query, which only widens it


def _strings(node) -> set[str] | None:
    """All strings a parsed part can match, if they are few; None if not."""
    op, arg = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "SUBPATTERN":
        return _sequence(arg[-1])
    if op == "BRANCH":
        found = [_sequence(x) for x in arg[1]]
        return None if None in found else set().union(*found)
    if op == "IN" and all(str(k) == "LITERAL" for k, _ in arg):
        return {chr(v).lower() for _, v in arg}
    if op in ("MAX_REPEAT", "MIN_REPEAT") and int(arg[1]) <= 8:
        one = _sequence(arg[2])
        if one is not None and len(one) ** int(arg[1]) <= _MOST:
            return {"".join(x) for n in range(int(arg[0]), int(arg[1]) + 1) for x in itertools.product(one, repeat=n)}
    return None


def _sequence(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        more = _strings(node)
        if more is None or len(out) * len(more) > _MOST:
            return None
        out = {a + b for a in out for b in more}
    return out


def trigram_query(regex: str) -> list[frozenset[str]]:
    """Alternatives of trigrams, one of which any match contains in full; empty: nothing is mandatory."""
    parts, run = [], {""}
    for node in [*re._parser.parse(regex), None]:
        more = None if node is None else _strings(node)
        if more is None or len(run) * len(more) > _MOST:
            parts.append(run)
            run = more if more is not None else {""}
        else:
            run = {a + b for a in run for b in more}
    parts.append(run)
    queries = []
    for strings in parts:
        sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
        if frozenset() not in sets:
            queries.append([s for s in sets if not any(t < s for t in sets)])
    if not queries:
        return []
    best = min(queries, key=lambda q: (len(q), -min(map(len, q))))  # the most selective mandatory part
    return sorted(best, key=sorted)


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(id, hash, kinds): documents that satisfy the trigram query of each of the rules named in kinds."""
    queries = [(r.kind, n, q) for r in rules for n, q in enumerate(trigram_query(r.regex))]
    grams = sorted({g for _, _, q in queries for g in q})
    folded = F.lower("text")
    postings = docs.select("id", "hash", F.explode(F.array_compact(F.array(
        *(F.when(F.contains(folded, F.lit(g)), F.lit(g)) for g in grams)))).alias("gram"))
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(g, kind, n, 1 << i, (1 << len(q)) - 1) for kind, n, q in queries for i, g in enumerate(sorted(q))],
                                   "gram string, kind string, alternative int, bit long, need long")
    both = postings.join(F.broadcast(wanted), "gram")  # a few rows per rule
    met = (both.groupBy("id", "hash", "kind", "alternative", "need").agg(F.bit_or("bit").alias("bits"))
           .where("bits = need"))
    return met.groupBy("id", "hash").agg(F.collect_set("kind").alias("kinds"))  # at most one per rule


def _search(rule: Rule) -> str:
    """A regex that finds a text without any counted match quickly; group 0 lengths are part of it."""
    return rule.regex[:-1] + f"{{{rule.least},}}" if re.fullmatch(r"\[[^\]]+\]\+", rule.regex) else rule.regex


def _spans(text: Column, rule: Rule, number: int) -> Column:
    gaps, hits = F.split(text, rule.regex, -1), F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group))
    each = F.zip_with(F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), F.coalesce(F.length(h), F.lit(0)).alias("hit"))),
                      values, lambda x, v: F.struct(x["gap"].alias("gap"), x["hit"].alias("hit"), F.length(v).alias("value")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        one = F.array(F.struct(start.alias("start"), F.lit(number).alias("kind"), (start + x["hit"]).alias("end")))
        return F.struct((start + x["hit"]).alias("at"),
                        F.when(x["value"] >= rule.least, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))
    return F.when(F.rlike(text, F.lit(_search(rule))), F.aggregate(each, start, step, lambda acc: acc["out"]))


def _digest(spans: Column, kinds: list[str]) -> Column:
    names = F.array(*(F.lit(k) for k in kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame, base: tuple[Rule, ...] = BASE, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """One row per input row: doc_id, found array<struct<start, kind, end>> (kind numbers base, then more)."""
    rules = (*base, *more)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumns({"id": id_key("doc_id"), "hash": F.xxhash64("text")})
    rows = texts.join(candidates(texts, rules), ["id", "hash"], "left")
    none = F.array().cast(_SPAN)
    found = []
    for i, rule in enumerate(rules):
        spans = _spans(F.col("text"), rule, i)
        if trigram_query(rule.regex):
            spans = F.when(F.array_contains("kinds", rule.kind), spans)
        found.append(F.coalesce(spans, none))
    return rows.select("doc_id", F.array_sort(F.concat(*found)).alias("found"))


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, a count per base kind, base_sha256 and all spans."""
    kinds = [r.kind for r in (*BASE, *MORE)]
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    of = F.transform("found", lambda s: s["kind"])
    counts = [F.size(F.array_remove(of, i)) for i in range(len(BASE))]
    counts = [(F.size("found") - n).cast("long").alias(f"n_{r.kind}") for n, r in zip(counts, BASE)]
    return scan_secrets(docs).select("doc_id", *counts, F.sha2(_digest(base, kinds), 256).alias("base_sha256"),
                                     _digest(F.col("found"), kinds).alias("spans"))
