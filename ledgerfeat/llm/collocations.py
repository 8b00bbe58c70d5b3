"""Phrase collocations by prefix-free parsing of the corpus.

1. A text is cut into pieces at punctuation and line ends, a piece into words. A piece is parsed into chunks: a chunk starts
   at the piece's first word and at every word whose hash is a trigger, and runs on into the next chunk by one word less than
   the longest phrase. Where chunks start depends on the words alone, so equal passages give equal chunks.
2. The distinct chunks of a language with the number of times the parse takes them are the dictionary. Everything after
   this step reads the dictionary and never a text.
3. Phrases are counted inside distinct chunks, weighted by the chunk's frequency. A phrase belongs to the chunk it starts in
   (``own`` words of it), never to the overlap, so each occurrence counts once.
4. Counting runs twice. First all phrases fall into hashed buckets: a bucket can only hold more than
   its phrases, so one below the least frequency has no candidate. Then only phrases of the other buckets are spelled out
   and counted exactly. A bit filter names those buckets; it has 16 bits for each up to ``FILTER_BITS`` in all, beyond which
   it lets more phrases through to the exact count but never fewer.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerfeat.llm.buckets import bucket_filter, full_buckets, grouped, packed_counts, passes
from ledgerfeat.llm.text import mix, span_hashes
from ledgerfeat.llm.stages import Stages

LONGEST = 3
#: One word in so many starts a chunk.
TRIGGER = 6
#: Hashed buckets for each word of the corpus, rounded up to a power of two, and the most bits of the filter over them (32 MB).
BUCKETS_A_WORD, FILTER_BITS = 16, 1 << 28
#: Phrases of the corpus for each part of the buckets: what one task adds up.
PART_PHRASES = 1 << 21
#: Parts in which the phrases of a language are ordered before the last ordering.
RANK_PARTS = 64
#: Bytes of text, distinct chunks, and bytes of chunks handled at once; texts or chunks in an Arrow batch.
TEXT_SLICE, CHUNKS, CHUNK_SLICE, BATCH_ROWS = 1 << 19, 150_000, 1 << 20, 2_000

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_STEP = np.uint64(0xD6E8FEB86659FD93)


def piece_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of ``data``, and whether it is the first of its piece."""
    kind = _KIND[np.frombuffer(data, np.uint8)]
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = kind == 0
    change = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = change[0::2], change[1::2]
    piece = np.cumsum(kind == 2)[starts]
    return starts, ends, np.append(True, piece[1:] != piece[:-1])[:len(starts)]


def parse(data: bytes, longest: int = LONGEST) -> list[tuple[int, bytes]]:
    """The chunks of ``data`` in order: own words, and the bytes with the overlap and a line end."""
    starts, ends, first = piece_words(data)
    if not len(starts):
        return []
    heads = np.flatnonzero(first | (span_hashes(data, starts, ends) % np.uint64(TRIGGER) == 0))
    own = np.diff(np.append(heads, len(starts)))
    firsts = np.flatnonzero(first)
    piece_end = np.append(firsts[1:], len(starts))[np.cumsum(first)[heads] - 1]
    stop = np.minimum(heads + own + longest - 1, piece_end)
    return [(o, data[s:e] + b"\n") for o, s, e in zip(own.tolist(), starts[heads].tolist(), ends[stop - 1].tolist())]


def _portions(text: bytes) -> Iterator[bytes]:
    """A text in parts of about ``TEXT_SLICE`` bytes that end where a piece ends."""
    at = 0
    while len(text) - at > TEXT_SLICE:
        cut = max(text.rfind(mark, at, at + TEXT_SLICE) for mark in (b".", b",", b"\n"))
        if cut < at:
            cut = min((p for p in (text.find(mark, at + TEXT_SLICE) for mark in (b".", b",", b"\n")) if p >= 0), default=len(text) - 1)
        yield text[at:cut + 1]
        at = cut + 1
    yield text[at:]


def _parse_batches(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, int, bytes], int] = {}

    def out() -> pa.RecordBatch:
        langs, own, chunks = zip(*counts) if counts else ((), (), ())
        made = pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(own, pa.int32()), pa.array(chunks, pa.binary()),
             pa.array(list(counts.values()), pa.int64())], names=["lang", "own", "chunk", "freq"])
        counts.clear()
        return made

    def add(lang: str, texts: list[bytes]) -> None:
        for own, chunk in parse(b"\n".join(texts).lower(), longest):
            key = (lang, own, chunk)
            counts[key] = counts.get(key, 0) + 1

    for batch in batches:
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            for part in _portions(text.as_py() or b""):
                waiting.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part)
                if sizes[lang] > TEXT_SLICE:
                    add(lang, waiting.pop(lang))
                    sizes[lang] = 0
            if len(counts) > CHUNKS:
                yield out()
        for lang, texts in waiting.items():
            add(lang, texts)
    yield out()


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST) -> DataFrame:
    """``lang``, ``own``, ``chunk`` and ``freq``: the distinct chunks of every language and how often the parse takes them.

    A null language is ``und``; a null text has no chunk. ``chunk`` holds A-Z lower-cased bytes and
    ends with a line end.
    """
    source = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    parts = source.mapInArrow(lambda it: _parse_batches(it, longest), "lang string, own int, chunk binary, freq long")
    return parts.groupBy("lang", "own", "chunk").agg(F.sum("freq").alias("freq"))


class _Phrases:
    """All phrases of some chunks: hash, weight, place and language of each, for one length."""

    def __init__(self, chunks: pa.Table) -> None:
        chunk = pa.chunked_array(chunks.column("chunk").chunks, pa.binary()).combine_chunks()
        offsets = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
        self.data = chunk.buffers()[2][int(offsets[0]):int(offsets[-1])].to_pybytes()
        self.starts, self.ends, first = piece_words(self.data)
        self.chunk = np.cumsum(first) - 1
        place = np.arange(len(self.starts)) - np.flatnonzero(first)[self.chunk]
        self.owned = place < chunks.column("own").to_numpy()[self.chunk]
        self.words = span_hashes(self.data, self.starts, self.ends)
        self.weight = chunks.column("freq").to_numpy()[self.chunk]
        langs = chunks.column("lang").combine_chunks().dictionary_encode()
        self.names = np.array(langs.dictionary.to_pylist(), object)
        self.lang = langs.indices.to_numpy()[self.chunk]
        salt = np.array([int.from_bytes(n.encode()[:7], "little") + 131 * len(n.encode()) for n in self.names], np.uint64)
        self.salt = mix(salt)[self.lang]

    def of_length(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the phrases of ``n`` words and their hashes."""
        at = np.flatnonzero(self.owned[:len(self.owned) - n + 1] & (self.chunk[n - 1:] == self.chunk[:len(self.chunk) - n + 1]))
        key = self.salt[at]
        for i in range(n):
            key = key * _STEP + self.words[at + i]
        return at, mix(key + np.uint64(n))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[_Phrases]:
    """The chunks of several batches together, up to about ``CHUNK_SLICE`` bytes."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            size += batch.column("chunk").nbytes
        if size > CHUNK_SLICE:
            yield _Phrases(pa.Table.from_batches(waiting))
            waiting.clear()
            size = 0
    if waiting:
        yield _Phrases(pa.Table.from_batches(waiting))


def _bucket_batches(batches: Iterator[pa.RecordBatch], longest: int, bucket_bits: int, part_bits: int) -> Iterator[pa.RecordBatch]:
    """Buckets and counts of a slice by the bucket's first bits, as arrays of its other bits and of counts."""
    for phrases in _slices(batches):
        keys, weights = [], []
        for n in range(1, longest + 1):
            at, hashes = phrases.of_length(n)
            keys.append(hashes >> np.uint64(64 - bucket_bits))
            weights.append(phrases.weight[at])
        buckets, sums, _ = grouped(np.concatenate(keys), np.concatenate(weights))
        yield packed_counts(buckets, sums, bucket_bits - part_bits)


def _phrase_batches(batches: Iterator[pa.RecordBatch], longest: int, bucket_bits: int, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    for phrases in _slices(batches):
        for n in range(1, longest + 1):
            at, hashes = phrases.of_length(n)
            at = at[passes(bits, hashes >> np.uint64(64 - bucket_bits))]
            # Occurrences are joined by two hashes, of the words and of the bytes, so that equal ones are the same phrase.
            key = phrases.salt[at]
            for i in range(n):
                key = key * _STEP + phrases.words[at + i]
            other = span_hashes(phrases.data, phrases.starts[at], phrases.ends[at + n - 1])
            keys, sums, places = grouped(mix(key) ^ other, phrases.weight[at])
            at = at[places]
            texts = [b" ".join(phrases.data[s:e].split()) for s, e in zip(phrases.starts[at].tolist(), phrases.ends[at + n - 1].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(phrases.names[phrases.lang[at]], pa.string()), pa.array(texts, pa.binary()),
                 pa.array(np.full(len(at), n, np.int32)), pa.array(sums)], names=["lang", "phrase", "n_words", "f"])


def phrase_counts(chunks: DataFrame, stages: Stages, least: int, longest: int = LONGEST) -> DataFrame:
    """``lang``, ``phrase``, ``n_words`` and the exact number of occurrences ``f`` of all phrases with ``f >= least``."""
    words = chunks.agg(F.sum(F.col("freq") * F.col("own"))).first()[0] or 0
    bucket_bits = max(10, (BUCKETS_A_WORD * words).bit_length())
    part_bits = (longest * words // PART_PHRASES).bit_length()
    parts = chunks.mapInArrow(lambda it: _bucket_batches(it, longest, bucket_bits, part_bits), "part long, buckets binary, counts binary")
    full = stages.write(parts.groupBy("part").applyInArrow(lambda part: full_buckets(part, least, bucket_bits - part_bits), "bucket long"))
    bits = chunks.sparkSession.sparkContext.broadcast(bucket_filter(full, FILTER_BITS))
    found = chunks.mapInArrow(lambda it: _phrase_batches(it, longest, bucket_bits, bits.value), "lang string, phrase binary, n_words int, f long")
    return (found.groupBy("lang", "phrase", "n_words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
            .select("lang", F.col("phrase").cast("string").alias("phrase"), "n_words", "f"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, longest: int = LONGEST,
                 covered_percent: int = 50, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of every language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    A-Z are lower-cased, pieces end at ``.,;:!?`` and line ends, words are what blanks and tabs part. Candidates have 2 to
    ``longest`` words and ``a >= least`` occurrences. A cut in two parts with ``l`` and ``r`` occurrences scores
    floor(1000000 * a * a / (l * r)); the lowest cut counts, the first of equal ones. A candidate goes if a longer one holds
    its words and ``100 * f(longer) >= covered_percent * a``. Ties are ranked by a, then by the phrase's bytes. ``n`` are
    the words of the language. Null texts are empty, a null language is ``und``, repeated rows count again, other columns
    are not read, and an empty table gives an empty table. Products are exact for up to 10**15 words.
    """
    with Stages(docs.sparkSession, BATCH_ROWS) as stages:
        chunks = stages.write(dictionary(docs, text_col, lang_col, longest))
        counted = stages.write(phrase_counts(chunks, stages, least, longest))
        totals = chunks.groupBy("lang").agg(F.sum(F.col("freq") * F.col("own")).alias("n"))
        words = F.split("phrase", " ")
        phrases = counted.where("n_words > 1").select("lang", "phrase", "n_words", F.col("f").alias("a"), words.alias("w"))
        parts = counted.select("lang", F.col("phrase").alias("part"), F.col("f"))

        def join(piece):
            return F.array_join(piece, " ")
        cuts = phrases.select("lang", "phrase", "n_words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
        cuts = cuts.select("lang", "phrase", "a", "k", join(F.slice("w", 1, F.col("k"))).alias("head"),
                           join(F.slice("w", F.col("k") + 1, F.col("n_words"))).alias("tail"))
        cuts = (cuts.join(parts.withColumnsRenamed({"part": "head", "f": "l"}), ["lang", "head"])
                .join(parts.withColumnsRenamed({"part": "tail", "f": "r"}), ["lang", "tail"]))
        exact = "CAST(CAST({0} AS DECIMAL(15,0)) * CAST({1} AS DECIMAL(15,0)) AS DECIMAL(31,0))"
        score = F.expr(f"CAST(1000000 AS DECIMAL(7,0)) * {exact.format('a', 'a')} div {exact.format('l', 'r')}")
        lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
            F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut"))

        spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("n_words") - 1), lambda m: F.transform(
            F.sequence(F.lit(1), F.col("n_words") - m + 1), lambda i: join(F.slice("w", i, m)))))
        inner = (phrases.where("n_words > 2").select("lang", "a", F.explode(spans).alias("phrase"))
                 .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
        kept = (lowest.join(inner, ["lang", "phrase"], "left")
                .where(f"longer IS NULL OR 100 * longer < {covered_percent} * a")
                .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
        order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        # The first of every part hold the first of the language, so one task orders a bounded number of rows.
        part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
        first = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= top)
        ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
        return stages.last(ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
