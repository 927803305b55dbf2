"""Language-model scores from an n-gram trie that is dealt out over the cluster.

Texts are tokenised once into blocks, which are stored. From then on blocks and
model parts exchange packed arrays, never a row for each token:

1. words: each block sends its distinct words with their training counts to the
   part their hash falls into, and gets back total counts and numbers;
2. pairs: each block sends its distinct pairs (word before, word) to the shard of
   the word before. A shard adds up the training counts, builds the trie of its
   pairs (Elias-Fano levels with quantised values, mapped from a file) and
   answers each block's pairs with their values; what is sent is compressed;
3. scores: each block adds up its texts' logarithms.

The model is a bigram with Dirichlet smoothing over the smoothed unigram ``p1``:
p(w | v) = (c(v, w) + STRENGTH * p1(w)) / (c(v) + STRENGTH), where the word before
a text's first is the end of a text. The trie holds log10 of c(v, w) / (c(v) +
STRENGTH) in 255 steps. A frequent word before, such as one with a third of all
tokens, has several shards, by the word that follows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import batches_of_bytes, held_in, stored
from martflow.llm.elias_fano import Trie
from martflow.llm.words import VISIBLE, Words, mixed

STRENGTH = 32.0
MOST_WORDS = 1 << 32
BLOCK_BYTES = 8 << 20
PART_BYTES = 8 << 20
#: Codes 1 to 255 stand for log10 values from LOWEST to 0; 0 for a pair that is not there.
LOWEST = -12.0
STEPS = 254
END_HASH = np.uint64(0x656E64)  # of no word: words are hashed, and this is far from random

BLOCK = (
    "block long, doc_ids array<long>, held array<boolean>, sizes array<int>, tokens binary, hashes binary, "
    "n_words long, n_tokens long"
)


def squeezed(values: np.ndarray) -> bytes:
    """An array's bytes, those of equal weight together, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def restored_array(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def steps(increasing: np.ndarray) -> np.ndarray:
    """Differences of an increasing sequence, which are small; ``np.cumsum`` restores it."""
    return np.diff(increasing, prepend=0).astype("<u4")


def _tokenise(batches):
    """Blocks of texts: each token's number in the block, texts ending with an end, and the words' hashes."""
    place = 0
    for batch in batches_of_bytes(batches, "text", BLOCK_BYTES):
        words = Words(batch.column("text"), VISIBLE)
        ends = words.bounds[1:]
        used, at = np.unique(words.ids, return_inverse=True) if len(words) else (words.starts, words.starts)
        hashes = np.append(words.vocabulary_hashes[used] if len(words) else np.zeros(0, np.uint64), END_HASH)
        # Words are numbered by hash, so that a part's words lie together.
        order = np.argsort(hashes)
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.arange(len(order))
        tokens = np.insert(number[at], ends, number[-1])
        partition = batch.column("partition")[0].as_py()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([(partition << 32) | place], pa.int64()),
                pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([batch.column("held_out").to_pylist()], pa.list_(pa.bool_())),
                pa.array([(words.counts + 1).tolist()], pa.list_(pa.int32())),
                pa.array([squeezed(tokens.astype("<u4"))], pa.binary()),
                pa.array([hashes[order].tobytes()], pa.binary()),
                pa.array([len(hashes)], pa.int64()),
                pa.array([len(tokens)], pa.int64()),
            ],
            names=[f.split()[0] for f in BLOCK.split(", ")],
        )
        place += 1


class Block:
    """Arrays of one row of blocks."""

    def __init__(self, row: dict):
        self.doc_ids, self.held = row["doc_ids"], np.array(row["held"], dtype=bool)
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        self.tokens = restored_array(row["tokens"], "<u4").astype(np.int64)
        self.n_words = row["n_words"]
        self.end = int(self.tokens[-1])
        self.training = np.repeat(~self.held, self.sizes)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.training], minlength=self.n_words)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (word before, word) as one number, each token's pair, and the pairs' training counts."""
        before = np.concatenate([[self.end], self.tokens[:-1]])
        keys, at = np.unique(before * self.n_words + self.tokens, return_inverse=True)
        return keys, at, np.bincount(at[self.training], minlength=len(keys))


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Parts are ranges of hashes, so a block's words, sorted by hash, are sorted by part."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


WORD_ROWS = "part int, block long, hashes binary, counts binary"


def _send_words(parts: int):
    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                hashes, counts = np.frombuffer(row["hashes"], "<u8"), Block(row).word_counts().astype("<u4")
                part = part_of(hashes, parts)
                first = np.flatnonzero(np.diff(part, prepend=-1))
                last = np.append(first, len(part))[1:]
                out = [
                    (int(part[a]), row["block"], hashes[a:b].tobytes(), squeezed(counts[a:b]))
                    for a, b in zip(first, last, strict=True)
                ]
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=["part", "block", "hashes", "counts"],
                )

    return send


ANSWERS = (
    "block long, part int, totals binary, numbers binary, words long, known long, tokens long, hot binary, "
    "hot_totals binary"
)


def _hottest(tokens: int, shards: int):
    """Of each part's most frequent words those with more than a shard's share of the corpus' tokens."""

    def pick(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                hot, totals = (np.frombuffer(row[name], dtype="<i8") for name in ("hot", "hot_totals"))
                wanted = totals * shards > tokens
                row["hot"], row["hot_totals"] = hot[wanted].tobytes(), totals[wanted].tobytes()
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

    return pick


def _count_words(hot_share: float):
    """Total counts of one part's words. A first row with no block has the part's sums and most frequent words.

    A word with a share of the corpus' tokens has at least that share of its part's.
    """

    def count(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        sent = [np.frombuffer(b, "<u8") for b in table.column("hashes").to_pylist()]
        counts = np.concatenate([restored_array(b, "<u4") for b in table.column("counts").to_pylist()])
        words, at = np.unique(np.concatenate(sent), return_inverse=True)
        totals = np.bincount(at, weights=counts, minlength=len(words)).astype(np.int64)
        hot = np.flatnonzero(totals > max(hot_share * totals.sum(), 1))
        sums = (len(words), int((totals > 0).sum()), int(totals.sum()))
        rows = [(None, part, None, None, *sums, hot.astype("<i8").tobytes(), totals[hot].astype("<i8").tobytes())]
        start = 0
        for block, own in zip(table.column("block").to_pylist(), sent, strict=True):
            mine = at[start : start + len(own)]
            start += len(own)
            rows.append((block, part, squeezed(totals[mine].astype("<i8")), squeezed(steps(mine)), *[None] * 5))
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 3, pa.binary(), pa.binary())
        names = [f.split()[0] for f in ANSWERS.split(", ")]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return count


class Vocabulary:
    """The parts' sums, and the words that have several shards: bounded by the number of parts and shards.

    A word's number is its place among all words that were sent, part after part.
    """

    def __init__(self, rows: list, parts: int, shards: int):
        self.shards = shards
        words = np.zeros(parts + 1, dtype=np.int64)
        for r in rows:
            words[r.part + 1] = r.words
        self.first_numbers = np.cumsum(words)
        self.distinct = sum(r.known for r in rows)
        self.tokens = sum(r.tokens for r in rows)
        none = np.zeros(0, dtype="<i8")
        numbers = np.concatenate([np.frombuffer(r.hot, "<i8") + self.first_numbers[r.part] for r in rows] or [none])
        totals = np.concatenate([np.frombuffer(r.hot_totals, "<i8") for r in rows] or [none])
        hot = totals * shards > self.tokens
        order = np.argsort(numbers[hot])
        self.hot, self.hot_totals = numbers[hot][order], totals[hot][order]
        self.ways = -(-self.hot_totals * shards // max(self.tokens, 1))

    def p1(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1))

    def resolve(self, answers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        """Total counts and numbers of a block's words."""
        answers = sorted(answers, key=lambda r: r["part"])
        totals = [restored_array(r["totals"], "<i8") for r in answers]
        numbers = [
            np.cumsum(restored_array(r["numbers"], "<u4").astype(np.int64)) + self.first_numbers[r["part"]] for r in answers
        ]
        return np.concatenate(totals), np.concatenate(numbers)

    def hot_place(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the numbers are those of words with several shards, and the places of all in their list."""
        if not len(self.hot):
            return np.zeros(len(numbers), dtype=bool), np.zeros(len(numbers), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hot, numbers), len(self.hot) - 1)
        return self.hot[at] == numbers, at

    def shards_of(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The shard of each pair of numbers."""
        hot, at = self.hot_place(before)
        way = np.zeros(len(before), dtype=np.uint64)
        way[hot] = mixed(word[hot]) % self.ways[at[hot]].astype(np.uint64)
        return part_of(mixed(before.astype(np.uint64) + way * np.uint64(0x9E3779B97F4A7C15)), self.shards)


class Exchange:
    """A block's pairs of known words, by shard and in number order, the same whenever it is made."""

    def __init__(self, block: Block, answers: list[dict], vocabulary: Vocabulary):
        self.totals, self.numbers = vocabulary.resolve(answers)
        keys, self.pair_of_token, counts = block.pairs()
        self.before, self.word = keys // block.n_words, keys % block.n_words
        known = np.flatnonzero((self.totals[self.before] > 0) & (self.totals[self.word] > 0))
        shard = vocabulary.shards_of(self.numbers[self.before[known]], self.numbers[self.word[known]])
        # Numbers grow with the words' places in the block, so pairs are sorted within a shard.
        order = np.argsort(shard, kind="stable")
        self.pairs, shard = known[order], shard[order]
        self.counts = counts[self.pairs]
        self.shards, self.first = np.unique(shard, return_index=True)
        self.last = np.append(self.first, len(self.pairs))[1:]


PACKED = ("before", "sizes", "words", "counts")
PAIR_ROWS = "shard int, block long, before binary, sizes binary, words binary, counts binary"


def _grouped(table: pa.Table) -> tuple[Block | None, int, list[dict], list[dict]]:
    """The block, its word answers and its pair answers among the rows of one block."""
    rows = table.to_pylist()
    block = next((r for r in rows if r["tokens"] is not None), None)
    return (
        Block(block) if block else None,
        rows[0]["block"],
        [r for r in rows if r["totals"] is not None],
        [r for r in rows if r["codes"] is not None],
    )


def _send_pairs(vocabulary):
    def send(table: pa.Table) -> pa.Table:
        block, name, answers, _ = _grouped(table)
        x = Exchange(block, answers, vocabulary.value)
        out = []
        for shard, a, b in zip(x.shards, x.first, x.last, strict=True):
            before = x.before[x.pairs[a:b]]
            first = np.flatnonzero(np.diff(before, prepend=-1))
            out.append(
                (
                    int(shard),
                    name,
                    squeezed(steps(x.numbers[before[first]])),
                    squeezed(np.diff(first, append=b - a).astype("<u4")),
                    squeezed(x.numbers[x.word[x.pairs[a:b]]].astype("<u4")),
                    squeezed(x.counts[a:b].astype("<u4")),
                )
            )
        kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
        columns = list(zip(*out, strict=True)) or [()] * len(kinds)
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in PAIR_ROWS.split(", ")]
        )

    return send


def quantised(values: np.ndarray) -> np.ndarray:
    """Codes 1 to 255 of positive values up to 1."""
    return (1 + np.clip(np.rint((np.log10(values) / -LOWEST + 1) * STEPS), 0, STEPS)).astype(np.uint8)


def restored(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** (((codes.astype(np.float64) - 1) / STEPS - 1) * -LOWEST), 0.0)


def _answer_pairs(vocabulary):
    """Builds one shard's trie from all blocks' pairs and looks all of them up in it."""

    def answer(table: pa.Table) -> pa.Table:
        columns = {n: [restored_array(b, "<u4").astype(np.int64) for b in table.column(n).to_pylist()] for n in PACKED}
        asked = [
            (np.repeat(np.cumsum(before), sizes), words)
            for before, sizes, words in zip(columns["before"], columns["sizes"], columns["words"], strict=True)
        ]
        keys = np.concatenate([(b << 32) | w for b, w in asked])
        found, at = np.unique(keys, return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate(columns["counts"]), minlength=len(found))
        held = counts > 0
        before, counts = found[held] >> 32, counts[held]
        # A word comes before another as often as it occurs, so its pairs add up to its count; of a word
        # with several shards the count is known to all.
        contexts, of = np.unique(before, return_inverse=True)
        totals = np.bincount(of, weights=counts, minlength=len(contexts))
        hot, place = vocabulary.value.hot_place(contexts)
        totals[hot] = vocabulary.value.hot_totals[place[hot]]
        trie = Trie(before, found[held] & 0xFFFFFFFF, quantised(counts / (totals[of] + STRENGTH)))
        return pa.table(
            {
                "block": table.column("block").cast(pa.int64()),
                "shard": table.column("shard").cast(pa.int32()),
                "codes": pa.array([squeezed(trie.lookup(b, w)) for b, w in asked], pa.binary()),
            }
        )

    return answer


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _score(vocabulary):
    def score(table: pa.Table) -> pa.Table:
        block, _, answers, coded = _grouped(table)
        v = vocabulary.value
        x = Exchange(block, answers, v)
        codes = np.zeros(len(x.before), dtype=np.uint8)
        by_shard = {r["shard"]: r["codes"] for r in coded}
        for shard, a, b in zip(x.shards, x.first, x.last, strict=True):
            codes[x.pairs[a:b]] = restored_array(by_shard[int(shard)], "u1")
        p1 = v.p1(x.totals)
        context = x.totals[x.before]
        p2 = restored(codes) + STRENGTH * p1[x.word] / (context + STRENGTH)
        cuts = np.concatenate([[0], np.cumsum(block.sizes)])[:-1]
        sums = lambda of_token: np.add.reduceat(of_token, cuts) if len(cuts) else of_token[:0]
        n = len(block.sizes)
        return pa.table(
            [
                pa.array(block.doc_ids, pa.int64()),
                pa.array(block.held),
                pa.array(block.sizes),
                pa.array(sums((x.totals > 0)[block.tokens].astype(np.int64))),
                pa.array(np.full(n, v.tokens)),
                pa.array(sums(np.log10(p1)[block.tokens])),
                pa.array(sums(np.log10(np.minimum(p2, 1.0))[x.pair_of_token])),
            ],
            names=[f.split()[0] for f in SCORES.split(", ")],
        )

    return score


def score_texts(docs: DataFrame, held_bucket: int = 1, buckets: int = 5, part_bytes: int = PART_BYTES) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its scores under a model of the rows that are not held out.

    Held out are rows whose crc32(doc_id as text) mod ``buckets`` is
    ``held_bucket``; null ids are not. Words are runs of anything but ASCII
    white space, A-Z lower-cased; each text has one end more, counted as a
    token. Returns doc_id, held_out, n_tokens, n_known (tokens that occur in
    training), train_tokens, base_score (log10 of the unigram probability) and
    score (log10 of the model's). Null and empty texts are the end alone;
    repeated rows count each time; an empty table gives an empty result, and
    without training rows both scores are those of an empty model. Further
    columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long"),
        held_in(held_bucket, buckets).alias("held_out"),
        F.spark_partition_id().alias("partition"),
        "text",
    )
    blocks = stored(texts.mapInArrow(_tokenise, BLOCK), "token-blocks")
    n_words, n_tokens = blocks.agg(
        F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))
    ).first()
    parts = max(1, -(-12 * n_words // part_bytes))
    shards = max(1, -(-8 * n_tokens // part_bytes))
    answers = stored(
        blocks.mapInArrow(_send_words(parts), WORD_ROWS).groupBy("part").applyInArrow(_count_words(1 / shards), ANSWERS),
        "word-counts",
    )
    # A row for each part, with at most as many words in all as there are shards.
    heads = answers.filter("block is null").select("part", "words", "known", "tokens", "hot", "hot_totals")
    words, tokens = heads.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    if words >= MOST_WORDS:
        raise ValueError(f"{words} distinct words: more than a word's number of 32 bits can tell")
    sums = heads.mapInArrow(_hottest(tokens, shards), heads.schema).collect()
    vocabulary = spark.sparkContext.broadcast(Vocabulary(sums, parts, shards))
    replies = answers.filter("block is not null").select("block", "part", "totals", "numbers")
    # Hashes are not read again: answers come in the order of the words.
    together = blocks.drop("hashes").unionByName(replies, allowMissingColumns=True)
    no_codes = together.withColumns({"shard": F.lit(None).cast("int"), "codes": F.lit(None).cast("binary")})
    pairs = no_codes.groupBy("block").applyInArrow(_send_pairs(vocabulary), PAIR_ROWS)
    codes = pairs.groupBy("shard").applyInArrow(
        _answer_pairs(vocabulary), "block long, shard int, codes binary"
    )
    return (
        together.unionByName(codes, allowMissingColumns=True).groupBy("block").applyInArrow(_score(vocabulary), SCORES)
    )
