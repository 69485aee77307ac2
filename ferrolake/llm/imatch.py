"""Document fingerprints by I-Match with randomised lexicons (operator 1, DataFrame functions only).

The lexicon holds the terms whose share of documents lies in a band (so their inverse document frequency
does). A text's fingerprint: its distinct lexicon terms, sorted; from them the terms of each of 144 randomised
lexicon subsets (up to 32 at each of five scales, keeping 1/16 to 1/4096 of the lexicon by a keyed hash); each
subset's sorted terms hashed into one 32-bit slot, zero for no term. Coarse subsets tell apart texts that
differ a little, fine ones survive edits. The likeness of two fingerprints is the share of equal slots among
those that are not zero in both, at the finest scale with enough of them: about one term a slot, it comes
near the Jaccard similarity of the two term sets.

Texts with fewer than ``LEAST`` lexicon terms use all their distinct terms; texts without any term are
hashed as they stand. So equal texts have equal fingerprints, always.

The lexicon's size is bounded whatever the corpus: every term in it is in a share of ``RARE`` of the documents
or more, so there are at most (distinct terms of a mean document) / RARE of them; only their hashes reach the
driver and the plan. Document frequencies are counted over all documents, combined in the map tasks.

Defined results: null text counts as empty; a null doc_id sorts first; for repeated rows of one doc_id each
row is reported, and as next document that id counts once, with its smallest text (by bytes) for the edit and
its smallest fingerprint for ``near_next``; a sole document is its own next; an empty table gives an empty
result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_key, ranked, stored

#: The band: least and largest share of the documents that a lexicon term is in.
RARE, COMMON = 0.005, 0.1
LEAST = 3
#: (first bit, bits, slots) at each scale: those bits of a term's hash are the number of its slot, if there is such a slot.
SCALES = ((0, 4, 16), (4, 6, 32), (10, 8, 32), (18, 10, 32), (28, 12, 32))
#: Slots not zero in both that a scale needs to be judged alone.
ENOUGH = 8


def _terms(text: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), ""))


def lexicon(docs: DataFrame, rare: float = RARE, common: float = COMMON) -> list[int]:
    """Hashes of the terms in the band: bounded by mean distinct terms / ``rare``."""
    n = docs.count()
    counts = (docs.select(F.explode(_terms(F.coalesce("text", F.lit("")))).alias("t"))
              .groupBy(F.xxhash64("t").alias("h")).count())
    return sorted(r.h for r in counts.where(F.col("count").between(max(2, rare * n), common * n)).select("h").collect())


#: What Spark's hash gives for an empty array: its seed.
_NO_TERM = 42


def _slot(h: Column) -> Column:
    """32 bits of a hash as an int."""
    return (h.bitwiseAND(F.lit(0xFFFFFFFF)) - F.lit(2**31)).cast("int")


def _value(h: Column, bit: int, bits: int) -> Column:
    return F.shiftrightunsigned(h, bit).bitwiseAND(F.lit(2**bits - 1))


def _in_scale(hashed: str, bit: int, bits: int, slots: int) -> Column:
    return F.filter(hashed, lambda h: _value(h, bit, bits) < slots)


def _filtered(hashed: str, bit: int, bits: int, n: int) -> Column:
    return F.filter(hashed, lambda h: _value(h, bit, bits) == n)


def with_fingerprint(df: DataFrame, text: str, out: str, terms: list[int]) -> DataFrame:
    """``df`` plus ``out``, an array of 32-bit slots. Each step is its own projection: it is evaluated once."""
    all_, some, hashed = f"__{out}_all", f"__{out}_some", f"__{out}_hashed"
    df = df.withColumn(all_, _terms(F.col(text)))
    df = df.withColumn(some, F.filter(all_, lambda t: F.xxhash64(t).isin(terms)) if terms else F.array().cast("array<string>"))
    chosen = F.array_sort(F.when(F.size(some) >= LEAST, F.col(some)).otherwise(F.col(all_)))
    df = df.withColumn(hashed, F.transform(chosen, lambda t: F.xxhash64(t)))
    scaled = {f"__{out}_{bit}": _in_scale(hashed, bit, bits, n) for bit, bits, n in SCALES}
    df = df.withColumns({**scaled, f"__{out}_none": F.size(hashed) == 0}).drop(all_, some, hashed)
    slots = []
    for bit, bits, n_slots in SCALES:
        for n in range(n_slots):
            mine = F.xxhash64(_filtered(f"__{out}_{bit}", bit, bits, n))
            slots.append(F.when(mine != _NO_TERM, _slot(mine)).otherwise(F.lit(0)))
    whole = F.transform(F.sequence(F.lit(1), F.lit(len(slots))), lambda i: _slot(F.xxhash64(i, text)))
    return df.withColumn(out, F.when(F.col(f"__{out}_none"), whole).otherwise(F.array(*slots))).drop(*scaled, f"__{out}_none")


def as_text(slots: str) -> Column:
    return F.lower(F.array_join(F.transform(slots, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))


def likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """``df`` plus ``out``: the share of equal slots among those used in either, at the finest scale with enough."""
    state = f"__{out}_state"
    df = df.withColumn(state, F.zip_with(a, b, lambda x, y: F.when((x == 0) & (y == 0), 0).when(x == y, 1).otherwise(2)))
    shares = []
    ends = list(accumulate(n for _, _, n in SCALES))
    for at, n in [*((end - n, n) for end, (_, _, n) in reversed(list(zip(ends, SCALES)))), (None, 0)]:
        part = F.col(state) if at is None else F.slice(state, at + 1, n)
        used = F.size(F.array_remove(part, 0))
        same = used - F.size(F.array_remove(F.array_remove(part, 0), 1))
        shares.append(F.when(used >= (1 if at is None else ENOUGH), same / used))
    return df.withColumn(out, F.coalesce(*shares, F.lit(1.0))).drop(state)


def successors(spark: SparkSession, ids: DataFrame) -> DataFrame:
    """``ids`` (id, need) as (id, for_id, need): each id follows for_id in ascending order, the first the last."""
    order = ranked(spark, ids, ["id"], "pos", "imatch-ids")
    n = max(1, order.count())
    before = order.select(F.col("id").alias("for_id"), "need", ((F.col("pos") + 1) % n).alias("pos"))
    return order.select("id", "pos").join(before, "pos").select("id", "for_id", "need")


def imatch_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per input row: fingerprints of the text and of its edited text, and their likeness."""
    base = docs.select(id_key("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    terms = lexicon(base)
    half = F.expr("length(text) div 2")
    follows = stored(spark, successors(spark, base.groupBy("id").agg(F.max(half).alias("need"))), "imatch-next")
    # The next document's text travels as the prefix that its predecessor needs.
    prefix = (base.join(follows, "id").select(F.col("for_id").alias("id"), F.expr("substring(text, 1, need)").alias("prefix"))
              .groupBy("id").agg(F.min("prefix").alias("prefix")))
    both = base.join(prefix, "id").withColumn(
        "edited", F.expr("concat(substring(text, 1, length(text) - length(text) div 2), substring(prefix, 1, length(text) div 2))"))
    both = both.select("id", F.length("text").cast("long").alias("n_chars"), "text", "edited",
                       F.sha2("edited", 256).alias("edited_sha256"))
    both = with_fingerprint(with_fingerprint(both, "text", "slots", terms), "edited", "edited_slots", terms)
    marked = stored(spark, both.drop("text", "edited"), "imatch-marked")
    following = (marked.join(follows, "id").groupBy(F.col("for_id").alias("id")).agg(F.min("slots").alias("next_slots")))
    out = marked.join(following, "id")
    out = likeness(likeness(out, "slots", "edited_slots", "near_edited"), "slots", "next_slots", "near_next")
    return out.select(F.when(F.col("id") != -(2**63), F.col("id")).alias("doc_id"), "n_chars", "edited_sha256",
                      as_text("slots").alias("fingerprint"), as_text("edited_slots").alias("edited_fingerprint"),
                      "near_edited", "near_next")
