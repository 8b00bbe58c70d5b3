"""Document fingerprints from closed syncmers of words, with built-in functions only.

A k-mer of ``K`` consecutive words is an anchor when the smallest of its inner ``S``-word substrings, by hash, lies at
its left or right edge. The choice depends on the k-mer alone, so an equal stretch of words gives equal anchors
wherever it stands, whatever surrounds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 4
S = 2
#: Shorter texts are cut into code points, since a few words leave no anchors to compare.
FEW_WORDS = 16
SEPARATORS = r"[\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once although the body names it inside loops."""
    return F.element_at(F.transform(F.array(value), body), 1)


def units(text: Column) -> Column:
    """The words of a text, or its code points when it has fewer than ``FEW_WORDS`` words."""
    text = F.coalesce(text, F.lit(""))
    found = F.filter(F.split(text, SEPARATORS), lambda w: w != "")
    return _let(found, lambda ws: F.when(F.size(ws) >= FEW_WORDS, ws).otherwise(F.filter(F.split(text, ""), lambda c: c != "")))


def anchors(text: Column) -> Column:
    """Hashes (32 bits) of the closed syncmers of a text, in text order.

    Fewer than ``K`` units make one anchor of the whole sequence; a null or empty text has none.
    """
    inner = K - S  # index of the last inner substring of a k-mer

    def chosen(pairs: Column) -> Column:
        def anchor(i: Column) -> Column:
            parts = [F.get(pairs, i + j) for j in range(inner + 1)]
            middle = F.least(*parts[1:])
            closed = (parts[0] <= middle) | (parts[inner] < F.least(*parts[:inner]))
            return F.when(closed, F.hash(*parts))
        return F.filter(F.transform(F.sequence(F.lit(0), F.size(pairs) - 1 - inner), anchor), lambda a: a.isNotNull())

    def paired(hashes: Column) -> Column:
        substrings = F.transform(F.sequence(F.lit(0), F.size(hashes) - S),
                                 lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(S)]))
        whole = F.array(F.hash(hashes))
        return (F.when(F.size(hashes) >= K, _let(substrings, chosen))
                .when(F.size(hashes) > 0, whole).otherwise(F.array().cast("array<int>")))

    return _let(F.transform(units(text), lambda w: F.xxhash64(w)), paired)


def fingerprint(found: Column) -> Column:
    """Anchors as one string: eight hexadecimal digits each, in text order."""
    return F.array_join(F.transform(found, lambda a: F.lpad(F.lower(F.hex(a.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(left: Column, right: Column) -> Column:
    """Twice the shared distinct anchors over both counts, 0 to 1; two empty fingerprints are alike."""
    shared = F.size(F.array_intersect(left, right))
    counts = F.size(F.array_distinct(left)) + F.size(F.array_distinct(right))
    return F.when(counts == 0, F.lit(1.0)).otherwise(2.0 * shared / F.greatest(counts, F.lit(1)))


def _ranges(ids: DataFrame, parts: int) -> tuple[Column, list[int | None], list[int]]:
    """Number of the id range of a row (0: greatest ids), and for every range its first id and the range before it.

    One number per range reaches the driver. The last range is for null ids.
    """
    shares = [i / parts for i in range(1, parts)] or [0.5]
    limits = ids.agg(F.percentile_approx("doc_id", shares, 10 * parts).alias("x")).first()["x"] or []
    limits = sorted(set(limits), reverse=True)
    borders = F.array(*[F.lit(x) for x in limits]).cast("array<bigint>")
    # Binary search in the falling limits: the number of those above the id, by powers of two.
    powers = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, len(limits).bit_length())))])
    above = F.aggregate(powers, F.lit(0), lambda n, p: F.when(F.get(borders, n + p - 1) > F.col("doc_id"), n + p).otherwise(n))
    number = F.when(F.col("doc_id").isNull(), len(limits) + 1).otherwise(above)
    firsts = {r["range"]: r["first"] for r in
              ids.groupBy(number.alias("range")).agg(F.max("doc_id").alias("first")).collect()}
    filled = sorted(firsts)
    before = {r: filled[i - 1] for i, r in enumerate(filled)}
    every = range(len(limits) + 2)
    return number, [firsts.get(r) for r in every], [before.get(r, -1) for r in every]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprints of every text (null: empty) and of its edit by the next document, with likenesses.

    Returns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next`` for every row. The edit replaces the last half of code points by the first as many of the next
    document, by descending id; after the last comes the first, and a single document follows itself. Equal ids (also
    repeated rows) are ordered by text, null ids come last. Other columns are not read. Ids are cut into ranges of
    about equal count, so that no task orders the whole table; the first documents of each range are repeated behind
    the range before it, which makes one shuffle of the texts enough. An empty table gives an empty table.
    """
    parts = parts or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number, firsts, before = _ranges(docs.select(F.col(id_col).cast("long").alias("doc_id")), parts)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("range", number)
    first_id = F.get(F.array(*[F.lit(x).cast("long") for x in firsts]), F.col("range"))
    its_reader = F.get(F.array(*[F.lit(x) for x in before]), F.col("range"))
    own = F.struct(F.col("range"), F.lit(False).alias("passed"))
    passed = F.struct(its_reader.alias("range"), F.lit(True).alias("passed"))
    copies = F.when(F.col("doc_id").eqNullSafe(first_id), F.array(own, passed)).otherwise(F.array(own))
    rows = rows.select("doc_id", "text", F.inline(copies))
    within = Window.partitionBy("range").orderBy("passed", F.col("doc_id").desc_nulls_last(), "text")
    rows = rows.withColumn("next_text", F.lead("text").over(within)).withColumn("anchors", anchors(F.col("text")))
    rows = rows.withColumn("next_anchors", F.lead("anchors").over(within)).where("NOT passed")
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_anchors", anchors(F.col("edited")))
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("anchors")).alias("fingerprint"), fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"))


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last half of code points replaced by the first as many (or all) of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))
