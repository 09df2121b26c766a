"""Masked pseudo-likelihood: every word is predicted from the words on both of its sides.

The vocabulary comes from word counts over the whole corpus. Texts become numbers once, which are stored; a small network
is trained on all of them, and scores them. The corpus is dealt over rounds, and a round's share over copies of some
hundred thousand words, by hashes of the texts, so that the layout of the files does not matter. All copies of a round
start from the average of the last one; they are averaged, by their words, in a tree of groups of bounded size. The network adds an embedding per place of the window, takes the hyperbolic
tangent, and predicts a word in two steps, its class and then the word in its class, each a softmax.
Rare words share ids; such a word's probability is that of its id times the word's share of the id's count.
A document's score is the sum of the logarithms of all its words' probabilities.
"""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import small, stored
from hackney.session import scratch

#: Classes, and words in a class.
CLASSES, MEMBERS = 32, 64
IDS = CLASSES * MEMBERS
#: Ids that rare words share, by a hash.
SHARED = 512
#: Rare words at most whose counts go to every task; those of all others are joined.
NEAR = 262_144
#: Different words that a task counts before it passes them on.
HELD = 500_000
#: Bytes of texts that are split into words at once, about.
PORTION = 4 << 20
#: Stands before the first and after the last word.
OUTSIDE = IDS
PLACES = (-2, -1, 1, 2)
SIZE = 16
BATCH = 2048
RATE = 0.15
#: Copies that a task averages at most.
FAN_IN = 8
#: Rounds of training at most, each over its own share of the corpus, and words that a copy sees in one, about.
ROUNDS, COPY = 8, 500_000


def one_thread() -> None:
    """Let matrix products of this process run in one thread, as a task has one core; more would wait for each other.

    Only speed depends on it, so where the library is another one, nothing is done.
    """
    try:
        with open("/proc/self/maps") as maps:
            libraries = {line.split()[-1] for line in maps if "openblas" in line}
    except OSError:
        return
    for path in libraries:
        library = ctypes.CDLL(path)
        for name in ("openblas_set_num_threads", "openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "scipy_openblas_set_num_threads64_"):
            if hasattr(library, name):
                getattr(library, name)(1)


def portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``PORTION`` bytes of texts, or a single longer one."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PORTION, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts, lower-cased in A-Z and split at white space, and where each text's begin and the last one's end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.values
    # White space at an end leaves an empty word.
    real = pc.greater(pc.binary_length(words), 0)
    ends = np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int64)]
    return words.filter(real), ends[lists.offsets.to_numpy()]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []

    def merged() -> pa.Table:
        sums = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("count", "sum")])
        return pa.table({"word": sums["word"], "count": sums["count_sum"]})

    for whole in batches:
        for batch in portions(whole):
            found = words_of(batch["text"])[0].dictionary_encode()
            many = np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary))
            held.append(pa.table({"word": found.dictionary.cast(pa.string()), "count": pa.array(many, pa.int64())}))
            if sum(map(len, held)) >= 2 * HELD:
                held = [merged()]
                if len(held[0]) >= HELD:
                    yield from held[0].to_batches()
                    held = []
    if held:
        yield from merged().to_batches()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``count`` of every word: lower-cased in A-Z and split at white space."""
    counts = docs.select("text").mapInArrow(_count, "word string, count bigint")
    return stored(counts.groupBy("word").agg(F.sum("count").alias("count")), "word-counts")


def vocabulary(docs: DataFrame) -> list[tuple[str, int]]:
    """The most frequent words, and what all others are counted as; at most ``IDS`` rows in all.

    Every word of every text is counted, see ``word_counts``.
    """
    return _most_frequent(word_counts(docs))


def _most_frequent(counts: DataFrame) -> list[tuple[str, int]]:
    own = counts.orderBy(F.desc("count"), "word").limit(IDS - SHARED)
    rows = [(r["word"], r["count"]) for r in own.collect()]
    total = counts.agg(F.sum("count")).first()[0] or 0
    return [*rows, ("", total - sum(n for _, n in rows))]


@dataclass
class Rare:
    """What tells the words of a shared id apart: their counts in the whole corpus.

    An id's words divide its count and one more, which all words outside the corpus have together. Of these
    as many are expected as there are others, and one besides.
    """

    counts: DataFrame
    """Of all words, as ``word_counts`` gives them."""
    near: dict[str, int]
    """The most frequent of the rare words."""
    tokens: np.ndarray
    """An id's count, for each shared id."""
    kinds: np.ndarray
    """An id's different words."""

    @classmethod
    def of(cls, counts: DataFrame, own: list[tuple[str, int]]) -> Rare:
        tokens, kinds = np.zeros(SHARED, np.int64), np.zeros(SHARED, np.int64)
        by_id = counts.groupBy((F.crc32(F.col("word").cast("binary")) % SHARED).alias("slot"))
        for r in by_id.agg(F.sum("count").alias("tokens"), F.count("*").alias("kinds")).collect():
            tokens[r["slot"]], kinds[r["slot"]] = r["tokens"], r["kinds"]
        for word, n in own:
            slot = zlib.crc32(word.encode()) % SHARED
            tokens[slot] -= n
            kinds[slot] -= 1
        # By levels of the count, of which there are few, so that no task sorts all words.
        level = F.floor(F.log2("count") * 8)
        least, many = None, 0
        for r in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True):
            if (many := many + r["n"]) > NEAR + len(own):
                break
            least = r["level"]
        frequent = [] if least is None else counts.filter(level >= least).collect()
        near, known = {r["word"]: r["count"] for r in frequent}, {w for w, _ in own}
        return cls(counts, {w: n for w, n in near.items() if w not in known}, tokens, kinds)


class Numbers:
    """Ids of words. Neighbours in frequency share a class; rare words have an id by their hash."""

    def __init__(self, words: list[str], near: Iterable[str] = ()) -> None:
        """The ids of rare words that are named in ``near`` are looked up, all others made."""
        every = [*words, *near]
        self._known = pa.array(every, pa.string())
        rare = [self.shared(w.encode()) for w in every[len(words) :]]
        # The last one is of words that are not known.
        self._ids = np.array([*range(len(words)), *rare, -1], np.int16)

    @staticmethod
    def shared(word: bytes) -> int:
        return IDS - SHARED + zlib.crc32(word) % SHARED

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.DictionaryArray]:
        """The words' ids, their places among all that are known (else -1), which words are not, and those words."""
        found = pc.fill_null(pc.index_in(words, value_set=self._known.cast(words.type)), -1).to_numpy()
        far = np.flatnonzero(found < 0)
        ids = self._ids[found]
        unknown = words.take(pa.array(far)).dictionary_encode()
        made = np.array([self.shared(w) for w in unknown.dictionary.cast(pa.large_binary()).to_pylist()], np.int16)
        ids[far] = made[unknown.indices.to_numpy()]
        return ids, found, far, unknown

    def ids(self, text: bytes) -> np.ndarray:
        return self.of(words_of(pa.array([text], pa.binary()).cast(pa.string()))[0])[0]


@dataclass
class Network:
    around: np.ndarray
    """An embedding per place, id and dimension."""
    to_class: np.ndarray
    to_member: np.ndarray
    class_bias: np.ndarray
    member_bias: np.ndarray
    _room: dict[int, list[np.ndarray]] = field(default_factory=dict, repr=False, compare=False)
    """Arrays that batches of a size share, as to get new ones takes as long as to fill them."""

    @classmethod
    def start(cls, counts: np.ndarray) -> Network:
        """Small random embeddings; the biases make each word as probable as it is frequent."""
        rng = np.random.default_rng(0)
        table = (counts.reshape(CLASSES, MEMBERS) + 0.5).astype(np.float64)
        by_class = table.sum(axis=1)
        draw = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        return cls(
            draw(len(PLACES), IDS + 1, SIZE), draw(SIZE, CLASSES), draw(SIZE, MEMBERS),
            np.log(by_class / by_class.sum()).astype(np.float32),
            np.log(table / by_class[:, None]).astype(np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.around, self.to_class, self.to_member, self.class_bias, self.member_bias]

    def pack(self) -> bytes:
        return np.concatenate([p.ravel() for p in self.parts()]).astype("<f4").tobytes()

    def unpack(self, raw: bytes) -> Network:
        """A network of this one's shape."""
        flat, out, at = np.frombuffer(raw, "<f4"), [], 0
        for part in self.parts():
            out.append(flat[at : at + part.size].reshape(part.shape).copy())
            at += part.size
        return Network(*out)

    def filled(self, value: float) -> Network:
        """Of this one's shape, with the same number everywhere."""
        return Network(*(np.full(p.shape, value, np.float32) for p in self.parts()))

    def _arrays(self, many: int) -> list[np.ndarray]:
        """Of a row per target: what is inside, what is added to it, scores of classes and members, biases, and a class's mark."""
        if many not in self._room:
            widths = (SIZE, SIZE, CLASSES, MEMBERS, MEMBERS, CLASSES)
            self._room = {many: [np.empty((many, width), self.around.dtype) for width in widths]}
        return self._room[many]

    def _forward(self, context: np.ndarray, target: np.ndarray) -> tuple:
        inside, added, by_class, by_member, bias, _ = self._arrays(len(target))
        self.around[0].take(context[0], axis=0, out=inside, mode="clip")
        for place in range(1, len(PLACES)):
            inside += self.around[place].take(context[place], axis=0, out=added, mode="clip")
        np.tanh(inside, out=inside)
        group, member = target // MEMBERS, target % MEMBERS
        rows = np.arange(len(target))
        self.member_bias.take(group, axis=0, out=bias, mode="clip")
        out = []
        for weights, own, more, scores, right in (
            (self.to_class, self.class_bias, self.class_bias, by_class, group),
            (self.to_member, self.member_bias, bias, by_member, member),
        ):
            np.matmul(inside, weights, out=scores)
            scores += more
            # What is within the hyperbolic tangent's bounds needs no shift to be within those of the exponential.
            if np.abs(weights).sum(axis=0).max() + np.abs(own).max() > 60:
                scores -= scores.max(axis=1, keepdims=True)
            chosen = scores[rows, right]
            np.exp(scores, out=scores)
            total = scores @ np.ones(scores.shape[1], scores.dtype)
            out.append((scores, total, chosen - np.log(total)))
        return inside, group, member, rows, out

    def log_probability(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each target, given the ids around it (a row per place)."""
        (*_, first), (*_, second) = self._forward(context, target)[-1]
        return first + second

    def gradients(self, context: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Of the summed loss: by what the embeddings add up to (valid until the next call), and by all parts but the embeddings."""
        inside, group, member, rows, out = self._forward(context, target)
        _, back, *errors, _, one_hot = self._arrays(len(target))
        for scores, (_, total, _), right in zip(errors, out, (group, member)):
            scores /= total[:, None]
            scores[rows, right] -= 1
        one_hot.fill(0)
        one_hot[rows, group] = 1
        slopes = [inside.T @ errors[0], inside.T @ errors[1], errors[0].sum(axis=0), one_hot.T @ errors[1]]
        np.matmul(errors[0], self.to_class.T, out=back)
        back += errors[1] @ self.to_member.T
        inside *= inside
        np.subtract(1, inside, out=inside)
        back *= inside
        return back, slopes


class Trainer:
    """One pass of Adagrad over batches, in the order in which they come.

    ``seen`` is what earlier passes have added up of the squared slopes, in the shape of the network.
    """

    def __init__(self, network: Network, seen: Network) -> None:
        self.network, self.seen = network, seen
        self._firsts = (np.arange(len(PLACES)) * (IDS + 1)).astype(np.int16)[:, None]

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        net, many = self.network, len(target)
        back, slopes = net.gradients(context, target)
        scale = np.float32(1 / np.sqrt(many))
        for part, seen, slope in zip(net.parts()[1:], self.seen.parts()[1:], slopes):
            slope = slope * scale
            seen += slope * slope
            part -= RATE * slope / np.sqrt(seen)
        # Rows of the embeddings of all places, those of the same row one after the other.
        row = (context + self._firsts).ravel()
        order = np.argsort(row, kind="stable")
        row = row[order]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        row = row[first].astype(np.intp)
        slope = np.add.reduceat(back.take(order % many, axis=0), first, axis=0)
        slope *= scale
        around, seen = (part.reshape(-1, SIZE) for part in (net.around, self.seen.around))
        sums = seen.take(row, axis=0)
        sums += slope * slope
        seen[row] = sums
        np.sqrt(sums, out=sums)
        slope *= np.float32(RATE)
        slope /= sums
        around[row] = around.take(row, axis=0) - slope


def windows(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All words of some texts, and the ids around each."""
    reach = max(PLACES)
    gap = np.full(reach, OUTSIDE, np.int16)
    line = np.concatenate([gap, *(part for i in ids for part in (i, gap))])
    at = np.flatnonzero(line != OUTSIDE)
    return line[at], np.stack([line[at + place] for place in PLACES])


ENCODED = (
    "key bigint, doc_id bigint, n_tokens bigint, ids binary, added double, far array<struct<word: string, n: int>>"
)


def _encode(words: list[str], rare: Rare):
    """Texts as numbers; ``added`` is what known rare words add to the score, ``far`` are those whose counts are not at hand."""
    near, tokens = rare.near, np.log1p(rare.tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers(words, near)
        # By place; the last one is of those that are not known.
        logs = np.r_[np.zeros(len(words)), np.log(np.array(list(near.values()), np.float64)), 0.0]
        lost = np.r_[np.zeros(IDS - SHARED), tokens]
        key = TaskContext.get().partitionId() << 40
        for whole in batches:
            for batch in portions(whole):
                every, ends = words_of(batch["text"])
                sizes, many = np.diff(ends), batch.num_rows
                ids, found, far, unknown = numbers.of(every)
                text = np.repeat(np.arange(many), sizes)
                added = np.bincount(text, logs[found] - lost[ids], many)
                # The unknown words of each text, and how often they are there.
                kinds = max(1, len(unknown.dictionary))
                pairs, often = np.unique(text[far] * kinds + unknown.indices.to_numpy(), return_counts=True)
                starts = pa.array(np.searchsorted(pairs, np.arange(many + 1) * kinds), pa.int32())
                named = unknown.dictionary.take(pa.array(pairs % kinds)).cast(pa.string())
                lists = pa.ListArray.from_arrays(starts, pa.StructArray.from_arrays([named, pa.array(often, pa.int32())], ["word", "n"]))
                buffers = [None, pa.py_buffer((2 * ends).astype(np.int32)), pa.py_buffer(ids.astype("<i2"))]
                packed = pa.Array.from_buffers(pa.binary(), many, buffers)
                keys = pa.array(np.arange(key, key + many), pa.int64())
                key += many
                columns = [keys, batch["doc_id"], pa.array(sizes, pa.int64()), packed, pa.array(added, pa.float64()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "n_tokens", "ids", "added", "far"])

    return run


def encoded(docs: DataFrame, words: list[str], rare: Rare) -> DataFrame:
    """The texts of ``docs`` as numbers, stored, since the keys are those of this pass."""
    return stored(docs.select("doc_id", "text").mapInArrow(_encode(words, rare), ENCODED), "encoded")


def _train(start: Network, weights: bytes, seen: bytes):
    def run(rows: pa.Table) -> pa.Table:
        """A copy trained on a group of texts, in the order of their hashes."""
        one_thread()
        trainer, total = Trainer(start.unpack(weights), start.unpack(seen)), 0
        order = np.lexsort((rows["key"].to_numpy(), rows["hash"].to_numpy()))
        packed = rows["ids"]
        texts = [np.frombuffer(packed[i].as_py(), "<i2").astype(np.int16) for i in order.tolist()]
        held: list[np.ndarray] = []
        for i, text in enumerate(texts):
            held.append(text)
            if sum(map(len, held)) < 16 * BATCH and i < len(texts) - 1:
                continue
            target, context = windows(held)
            for at in range(0, len(target), BATCH):
                trainer.step(context[:, at : at + BATCH], target[at : at + BATCH])
            total += len(target)
            held = []
        columns = [pa.array([rows["copy"][0].as_py()], pa.int64()), pa.array([total], pa.int64())]
        columns += [pa.array([net.pack()], pa.binary()) for net in (trainer.network, trainer.seen)]
        return pa.Table.from_arrays(columns, ["slot", "words", "weights", "seen"])

    return run


def _average(rows: pa.Table) -> pa.Table:
    """One copy for all of a group, weighted by words."""
    words = np.array(rows["words"].to_pylist(), np.float64)

    def mean(name: str) -> pa.Array:
        total = sum(n * np.frombuffer(w.as_py(), "<f4").astype(np.float64) for n, w in zip(words, rows[name]))
        return pa.array([(total / words.sum()).astype("<f4").tobytes()], pa.binary())

    slot = rows["slot"][0].as_py() // FAN_IN
    columns = [pa.array([slot], pa.int64()), pa.array([int(words.sum())], pa.int64()), mean("weights"), mean("seen")]
    return pa.Table.from_arrays(columns, ["slot", "words", "weights", "seen"])


COPIES = "slot bigint, words bigint, weights binary, seen binary"


@dataclass
class Model:
    words: list[str]
    network: Network
    rare: Rare


def fit(docs: DataFrame) -> Model:
    """Train on all words of ``docs``. Without words the model is its own start, all words alike."""
    return _fit(docs)[0]


def _vocabulary(docs: DataFrame) -> tuple[list[str], Rare, Network]:
    """The words with an id, what tells others apart, and the network that makes each id as probable as it is frequent."""
    every = word_counts(docs)
    counted = _most_frequent(every)
    rare = Rare.of(every, counted[:-1])
    words = [w for w, _ in counted[:-1]]
    counts = np.zeros(IDS)
    counts[: len(words)] = [n for _, n in counted[:-1]]
    counts[IDS - SHARED :] = counted[-1][1] / SHARED
    return words, rare, Network.start(counts)


def _fit(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and ``docs`` as numbers."""
    words, rare, start = _vocabulary(docs)
    rows = encoded(docs, words, rare)
    return Model(words, train(rows, start), rare), rows


def train(rows: DataFrame, start: Network) -> Network:
    """The network trained on all words of ``rows``, texts as numbers."""
    total = rows.agg(F.sum("n_tokens")).first()[0] or 0
    rounds = max(1, min(ROUNDS, round(total / COPY)))
    copies = max(1, round(total / (rounds * COPY)))
    texts = rows.filter("n_tokens > 0").select("key", "ids", "n_tokens", F.xxhash64("ids", "doc_id").alias("hash"))
    # A hash with much of a copy's words, of a row that is there very often, is dealt by the rows' keys.
    often = texts.groupBy("hash").agg(F.sum("n_tokens").alias("all"), F.count("*").alias("rows"))
    often = stored(often.filter((F.col("all") > COPY // 4) & (F.col("rows") > 1)).select(F.col("hash").alias("__often")), "often")
    if not often.isEmpty():
        texts = texts.join(often, F.col("hash") == F.col("__often"), "left")
        texts = texts.withColumn("hash", F.when(F.col("__often").isNull(), F.col("hash")).otherwise(F.xxhash64("hash", "key")))
    dealt = F.pmod(F.col("hash"), F.lit(rounds * copies))
    texts = texts.select("key", "ids", "hash", F.floor(dealt / rounds).alias("copy"), (dealt % rounds).cast("int").alias("round"))
    path = scratch(rows.sparkSession, "rounds")
    texts.write.partitionBy("round").parquet(path)
    texts = rows.sparkSession.read.schema(texts.schema).parquet(path)
    weights, seen = start.pack(), start.filled(1e-2).pack()
    for n in range(rounds):
        share = texts.filter(F.col("round") == n).drop("round")
        made = stored(share.groupBy("copy").applyInArrow(_train(start, weights, seen), COPIES), "copies")
        while (many := made.count()) > 1 or many and made.first()["slot"]:
            made = stored(made.groupBy(F.floor(F.col("slot") / FAN_IN)).applyInArrow(_average, COPIES), "copies")
        if (merged := made.first()) is not None:
            weights, seen = merged["weights"], merged["seen"]
    return start.unpack(weights)


SCORED = "key bigint, doc_id bigint, n_tokens bigint, score double, far array<struct<word: string, n: int>>"


def _score(network: Network):
    """Scores that lack the counts of the words in ``far``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        for whole in batches:
            for batch in small(whole):
                ids = [np.frombuffer(x.as_py(), "<i2").astype(np.int16) for x in batch.column(3)]
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                target, context = windows(ids)
                found = [np.zeros(0, np.float32)]
                for at in range(0, len(target), BATCH):
                    found.append(network.log_probability(context[:, at : at + BATCH], target[at : at + BATCH]))
                sums = np.r_[0.0, np.cumsum(np.concatenate(found), dtype=np.float64)]
                last = np.cumsum(sizes)
                scores = sums[last] - sums[last - sizes] + batch.column(4).to_numpy()
                columns = [*batch.columns[:3], pa.array(scores), batch.column(5)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "n_tokens", "score", "far"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """A row per document: ``doc_id``, ``n_tokens``, ``score`` and ``per_token``.

    ``score`` is the sum of the words' log-probabilities, ``per_token`` their mean. Null and empty texts have
    no words, ``score`` 0 and ``per_token`` null. ``doc_id`` may be null; repeated rows come back as often.
    """
    return _scored(encoded(docs, model.words, model.rare), model)


def fit_and_score(docs: DataFrame) -> DataFrame:
    """``score`` by a model of the documents themselves, which become numbers once."""
    model, rows = _fit(docs)
    return _scored(rows, model)


def _scored(texts: DataFrame, model: Model) -> DataFrame:
    rows = texts.mapInArrow(_score(model.network), SCORED)
    rows = stored(rows, "scores")
    far = rows.select(F.col("key").alias("of"), F.explode("far").alias("far")).select("of", "far.*")
    far = far.join(model.rare.counts, "word", "left")
    slot = (F.crc32(F.col("word").cast("binary")) % SHARED).cast("int")
    outside = F.get(F.array(*map(F.lit, (-np.log1p(model.rare.kinds)).tolist())), slot)
    term = F.col("n") * F.coalesce(F.log(F.col("count").cast("double")), outside)
    far = far.groupBy("of").agg(F.sum(term).alias("more"))
    whole = F.col("score") + F.coalesce("more", F.lit(0.0))
    mean = F.when(F.col("n_tokens") > 0, whole / F.col("n_tokens"))
    joined = rows.join(far, F.col("key") == F.col("of"), "left")
    return joined.select("doc_id", "n_tokens", whole.alias("score"), mean.alias("per_token"))
