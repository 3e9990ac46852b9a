"""Language-model scores by online logistic context mixing, beside a unigram base.

Method. A text is its lower-cased words, each followed by a space, the last by an end. Symbols are coded
as bits on a Huffman tree of the training corpus, so a symbol takes about four binary decisions.
Hashed-context predictors (the last ORDERS symbols, and the beginning of the current word) keep how
often each bit followed in each hashed slot, over all training texts. Their stretched probabilities are
added with weights gated by the depth in the tree and the place in the word; weights are learnt online,
block after block, on a fold of the training texts that the counts leave out (partitions' weights are
averaged by bits, parts and their order follow from the rows), and then the fold's own counts join. While a text is scored, weights go on adapting
to it after every BLOCK symbols, from anew in every SEGMENT, and a table of how mixed probabilities came true on the
fold refines the result. Every decision is priced before it is learnt from, so the prices of a text
are a probability of it.

The base counts training tokens exactly: the HEAD most frequent go to all tasks, the others meet by a
join. Texts with crc32(doc_id as text) mod 7 = 2 are held out of all training. Null texts are empty:
one end token. Without training rows probabilities are uniform at first. Rows that repeat an id are
scored and counted each. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import read, written
from ._runs import lean
from ._tables import summed_table
from ._text import LOWER, pieces, utf8, word_spans, words

FOLDS, HELD_OUT, WEIGHT_FOLD = 7, 2, 3
HEAD = 1 << 18
ORDERS = (3, 5)
WORD_REACH = 12
MODELS = len(ORDERS) + 1
#: Slots of each predictor; one byte each is broadcast.
SLOT_BITS = 21
#: Rows of the weights' fold a part on average, and the most parts; a part's weights are learnt in the order of ids.
PART_ROWS, PARTS = 512, 1024
#: How many neighbouring slots the decisions of a symbol share in one context.
NEAR = 64
SEGMENT, BLOCK = 2048, 64
DEPTHS, PLACES = 8, 8
BUCKETS = 33
RATE, TRAIN_RATE = 0.004, 0.05
SYMBOLS, END = 257, 256
PIECE = 192 << 10
#: Bytes of text that are counted at once; their decisions stay in a core's own cache.
COUNT_PIECE = 32 << 10


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def sequences(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts in a row, the place of each in its word, and the n + 1 offsets of texts."""
    data, offsets = utf8(column)
    starts, ends = word_spans(data, offsets)
    first = np.searchsorted(starts, offsets, "left")
    number = np.diff(first)
    size = ends - starts + 1
    word_at = np.concatenate([[0], np.cumsum(size)])
    # texts without words consist of an end alone
    lone = np.cumsum(number == 0)
    at = word_at[first] + np.concatenate([[0], lone])
    seq = np.full(at[-1], END, np.int16)
    place = np.zeros(at[-1], np.int32)
    if len(starts):
        shift = (np.concatenate([[0], lone])[:-1])[np.repeat(np.arange(len(number)), number)]
        begin = word_at[:-1] + shift
        inner = np.arange(word_at[-1], dtype=np.int64) - np.repeat(word_at[:-1], size)
        target = inner + np.repeat(begin, size)
        source = np.minimum(inner + np.repeat(starts, size), len(data) - 1)
        stop = inner == np.repeat(size - 1, size)
        seq[target] = np.where(stop, 32, LOWER[data[source]])
        place[target] = inner
        last = first[1:][number > 0] - 1
        seq[begin[last] + size[last] - 1] = END
    return seq, place, at


def contexts(seq: np.ndarray, place: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The slot of each symbol for each predictor, by a hash of what stands before it in its text."""
    n = len(seq)
    inside = np.arange(n, dtype=np.int64) - np.repeat(at[:-1], np.diff(at))
    wide = np.concatenate([np.full(max(*ORDERS, WORD_REACH), END, np.uint32), seq.astype(np.uint32)])
    prior, shift = np.empty(n, np.uint32), np.empty(n, np.uint32)
    out = []
    for m, reach in enumerate((*ORDERS, WORD_REACH)):
        h = np.full(n, (m + 1) * 0x3C6EF372, np.uint32)
        at_least = (inside if m < len(ORDERS) else place).astype(np.int32)
        for j in range(1, reach + 1):
            np.copyto(prior, wide[len(wide) - n - j : len(wide) - j])
            np.copyto(prior, np.uint32(END + 1), where=at_least < j)
            h ^= prior
            h *= np.uint32(0x01000193)
            h ^= np.right_shift(h, np.uint32(15), out=shift)
        h *= np.uint32(0x85EBCA6B)
        h ^= np.right_shift(h, np.uint32(13), out=shift)
        h *= np.uint32(0xC2B2AE35)
        h >>= np.uint32(32 - SLOT_BITS)
        out.append(h)
    return out


def huffman(counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Code lengths of all symbols, where each code begins in the flat tables of all decisions, and of
    each decision what its inner node adds to a slot, its bit and its gate by depth."""
    heap = [(int(c) + 1, s, s) for s, c in enumerate(counts)]
    heapq.heapify(heap)
    up: dict[int, tuple[int, int]] = {}
    new = SYMBOLS
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        up[a[2]], up[b[2]] = (new, 0), (new, 1)
        heapq.heappush(heap, (a[0] + b[0], new, new))
        new += 1
    paths = []
    for s in range(SYMBOLS):
        path = []
        while s in up:
            path.append((up[s][0] - SYMBOLS, up[s][1]))
            s = up[s][0]
        paths.append(path[::-1])
    length = np.array([len(p) for p in paths])
    begin = np.cumsum(length) - length
    # the nodes nearest to the root, numbered last, get slots of their own; the others share the rest
    own = NEAR // 2
    from_root = [SYMBOLS - 2 - x for p in paths for x, _ in p]
    node = np.array([x if x < own else own + x % own for x in from_root])
    bit = np.array([x for p in paths for _, x in p])
    gate = np.array([min(d, DEPTHS - 1) * PLACES for p in paths for d in range(len(p))])
    return length, begin, node, bit, gate


def decisions(tree, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many decisions each symbol takes, the symbol of each, and the place of each in the flat tables."""
    length, begin = tree[:2]
    n = length.take(symbols)
    symbol = np.repeat(np.arange(len(n)), n)
    code = (begin.take(symbols) - (np.cumsum(n) - n)).take(symbol)
    code += np.arange(len(symbol))
    return n, symbol, code


def slots(symbol_slot: np.ndarray, symbol: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The slot of each decision, NEAR neighbouring ones for all decisions of a symbol, which memory reads at once."""
    return symbol_slot.astype(np.int64).take(symbol) ^ node


def bit_counts(docs: DataFrame, tree) -> np.ndarray:
    """How often each bit followed in each slot: MODELS x slots x 2."""
    size = 2 << SLOT_BITS

    def update(total, batch):
        for p in pieces(batch, "text", COUNT_PIECE):
            seq, place, at = sequences(p.column("text"))
            _, symbol, code = decisions(tree, seq)
            node = (tree[2] << 1 | tree[3]).take(code)
            for m, h in enumerate(contexts(seq, place, at)):
                np.add.at(total[m * size : (m + 1) * size], slots(h << np.uint32(1), symbol, node), np.uint32(1))

    return summed_table(docs.select("text"), MODELS * size, update, np.uint32).reshape(MODELS, 1 << SLOT_BITS, 2)


def stretched(counts: np.ndarray) -> np.ndarray:
    """Log odds of a one in each slot, in sixteenths."""
    odds = lambda c: 16 * np.log((c[:, 1] + np.float32(0.1)) / (c[:, 0] + np.float32(0.1)))
    return np.stack([np.clip(np.rint(odds(c)), -127, 127).astype(np.int8) for c in counts])


class Mixer:
    """Mixes the predictors over many segments of texts at once, a block of each at a time."""

    def __init__(self, tree, table: np.ndarray, weights: np.ndarray, refine: np.ndarray | None):
        self.tree, self.table, self.weights = tree, table, weights.copy()
        self.refine = refine  # how often a mixed probability's bucket came out 0 and 1, or None
        self.came = np.zeros((DEPTHS * PLACES * BUCKETS, 2))
        self.bits = 0

    def prices(self, column, learn: bool) -> np.ndarray:
        """Natural log probability of each text."""
        seq, place, at = sequences(column)
        hashes = contexts(seq, place, at)
        size = np.diff(at)
        text = np.repeat(np.arange(len(size)), size)
        inside = np.arange(len(seq)) - at[text]
        parts = -(-size // SEGMENT)
        lane = (np.cumsum(parts) - parts)[text] + inside // SEGMENT
        lanes = int(parts.sum())
        block = (inside % SEGMENT // BLOCK).astype(np.uint16)
        order = np.argsort(block, kind="stable")
        cut = np.searchsorted(block[order], np.arange(SEGMENT // BLOCK + 1))
        price = np.zeros(lanes)
        own = np.zeros((MODELS, lanes), np.float32)
        spot = np.minimum(place, PLACES - 1).astype(np.int64)
        bits = self.tree[3].astype(np.float32)
        sse = None
        if self.refine is not None:
            odds = np.log((self.refine[:, 1] + 20 * self._center()) / (self.refine[:, 0] + 20 * (1 - self._center())))
            sse = (1 / (1 + np.exp(-odds))).astype(np.float32)
        for lo, hi in zip(cut[:-1], cut[1:]):
            i = order[lo:hi]
            if not len(i):
                break
            n, symbol, code = decisions(self.tree, seq[i])
            node, b = self.tree[2].take(code), bits.take(code)
            gate = spot[i].take(symbol)
            gate += self.tree[4].take(code)
            # a block's symbols come lane after lane
            first = np.flatnonzero(np.diff(lane[i], prepend=-1))
            there = lane[i[first]]
            begin = (np.cumsum(n) - n)[first]
            width = np.diff(begin, append=len(code))
            st = [self.table[m].take(slots(hashes[m][i], symbol, node)) * np.float32(1 / 16) for m in range(MODELS)]
            dot = self.weights[MODELS].take(gate)
            for m in range(MODELS):
                weight = self.weights[m].take(gate)
                if not learn:
                    weight += np.repeat(own[m][there], width)
                weight *= st[m]
                dot += weight
            np.clip(dot, -11, 11, out=dot)
            p = np.exp(-dot)
            p += 1
            np.divide(1, p, out=p)
            err = b - p
            np.clip(dot, -8, 8, out=dot)
            dot *= 2
            dot += np.float32(16.5)
            cell = dot.astype(np.int64)
            cell += gate * BUCKETS
            if learn:
                self.bits += len(code)
                count = np.bincount(gate, minlength=DEPTHS * PLACES) + 10
                for m in range(MODELS):
                    self.weights[m] += TRAIN_RATE * (np.bincount(gate, err * st[m], DEPTHS * PLACES) / count).astype(np.float32)
                self.weights[MODELS] += TRAIN_RATE * (np.bincount(gate, err, DEPTHS * PLACES) / count).astype(np.float32)
                cell *= 2
                cell += self.tree[3].take(code)
                self.came += np.bincount(cell, minlength=self.came.size).reshape(-1, 2)
                continue
            if sse is not None:
                p += sse.take(cell)
                p *= np.float32(0.5)
            # p where the bit is one, 1 - p where it is none
            np.subtract(1 - b, p, out=p)
            np.abs(p, out=p)
            price[there] += np.add.reduceat(np.log(p, out=p), begin, dtype=np.float64)
            err *= np.float32(RATE)
            for m in range(MODELS):
                own[m][there] += np.add.reduceat(err * st[m], begin)
        return np.bincount(np.repeat(np.arange(len(size)), parts), price, len(size))

    @staticmethod
    def _center() -> np.ndarray:
        mid = 1 / (1 + np.exp(-(np.arange(BUCKETS) - 16) / 2))
        return np.tile(mid, DEPTHS * PLACES)


def learnt(docs: DataFrame, parts: int, tree, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gated weights learnt online on docs in `parts` parts, and how mixed probabilities came true. Parts and their order
    follow from the rows alone, not from how many tasks read them."""
    start = np.full((MODELS + 1, DEPTHS * PLACES), 0.6, np.float32)
    start[MODELS] = 0
    shared = docs.sparkSession.sparkContext.broadcast((tree, table))

    def train(batches):
        mixer = Mixer(*shared.value, start, None)
        for batch in batches:
            for p in pieces(batch, "text", PIECE):
                mixer.prices(p.column("text"), True)
        yield pa.RecordBatch.from_pydict({"bits": [mixer.bits], "weights": [mixer.weights.tobytes()], "came": [mixer.came.tobytes()]})

    mark = F.xxhash64("doc_id", "text")
    rows = docs.select("doc_id", "text", mark.alias("mark")).repartition(parts, "mark").sortWithinPartitions("doc_id", "mark").select("text")
    # a row of fixed size from each of a bounded number of tasks
    got = rows.mapInArrow(lean(train), "bits long, weights binary, came binary").toPandas()
    bits = max(1, got["bits"].sum())
    weights = sum((np.frombuffer(w, np.float32).reshape(start.shape) * (n / bits) for w, n in zip(got["weights"], got["bits"])), np.zeros(start.shape, np.float32))
    came = sum((np.frombuffer(c).reshape(-1, 2) for c in got["came"]), np.zeros((DEPTHS * PLACES * BUCKETS, 2)))
    return (weights if got["bits"].sum() else start).astype(np.float32), came


def token_counts(train: DataFrame) -> DataFrame:
    """symbol, h, c: how often each training word occurs, by its 64-bit hash, and, where symbol, each symbol h."""

    def count(batches):
        sums = np.zeros(SYMBOLS, np.int64)
        for batch in batches:
            for p in pieces(batch, "text"):
                sums[:END] += np.bincount(LOWER[utf8(p.column("text"))[0]], minlength=END)
                sums[END] += p.num_rows
                h, n = np.unique(words(p.column("text"))[0], return_counts=True)
                yield pa.RecordBatch.from_pydict({"symbol": np.zeros(len(h), bool), "h": h.view(np.int64), "c": n.astype(np.int64)})
        yield pa.RecordBatch.from_pydict({"symbol": np.ones(SYMBOLS, bool), "h": np.arange(SYMBOLS), "c": sums})

    return train.select("text").mapInArrow(lean(count), "symbol boolean, h long, c long").groupBy("symbol", "h").agg(F.sum("c").alias("c"))


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte (the model's bits over the text's
    UTF-8 bytes; null for an empty text) of every row of docs."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("fold", fold(F.col("doc_id")))
    train = docs.where(F.col("fold") != HELD_OUT)
    tallies = written(token_counts(train))
    counts = tallies.where("not symbol").select("h", "c")
    frequency = np.zeros(SYMBOLS, np.int64)
    for r in tallies.where("symbol").collect():
        frequency[r.h] = r.c
    ends, fold_rows = train.agg(F.count("*"), F.count_if(F.col("fold") == WEIGHT_FOLD)).first()
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, kinds = total + ends, kinds + (ends > 0)
    floor_ = np.log10(total + kinds + 1)
    head = counts.orderBy(F.desc("c"), "h").limit(HEAD).toPandas().sort_values("h")
    # longs and 64-bit hashes sort alike in both as signed numbers
    known = spark.sparkContext.broadcast((head["h"].to_numpy(np.int64), head["c"].to_numpy(np.int64)))

    tree = huffman(frequency)
    counted = bit_counts(train.where(F.col("fold") != WEIGHT_FOLD), tree)
    fold_docs = train.where(F.col("fold") == WEIGHT_FOLD)
    weights, came = learnt(fold_docs, min(max(fold_rows // PART_ROWS, 1), PARTS), tree, stretched(counted))
    counted += bit_counts(fold_docs, tree)
    model = spark.sparkContext.broadcast((tree, stretched(counted), weights, came))
    del counted

    def score(batches):
        mixer = Mixer(*model.value)
        hs, cs = known.value
        for batch in batches:
            for p in pieces(batch, "text", PIECE):
                price = mixer.prices(p.column("text"), False) / np.log(10)
                h, at = words(p.column("text"))
                h, row = h.view(np.int64), np.repeat(np.arange(p.num_rows), np.diff(at))
                distinct, inverse = np.unique(h, return_inverse=True)
                spot = np.minimum(np.searchsorted(hs, distinct), max(len(hs) - 1, 0))
                there = hs[spot] == distinct if len(hs) else np.zeros(len(distinct), bool)
                gain = np.where(there, np.log10((cs[spot] if len(hs) else 0) + 1.0), 0.0)
                found = there[inverse]
                base = np.bincount(row, gain[inverse], p.num_rows) - floor_ * (np.diff(at) + 1) + np.log10(ends + 1)
                n_known = np.bincount(row, found, p.num_rows).astype(np.int64) + (ends > 0)
                # words outside the head meet their counts in a join
                rest = np.flatnonzero(~found)
                tail_at = np.searchsorted(row[rest], np.arange(p.num_rows + 1))
                tail = pa.ListArray.from_arrays(pa.array(tail_at, pa.int32()), pa.array(h[rest], pa.int64()))
                size = pa.array(np.diff(utf8(p.column("text"))[1]))
                yield pa.RecordBatch.from_arrays([p.column("rid"), p.column("doc_id"), p.column("fold"), pa.array(np.diff(at) + 1), pa.array(n_known), pa.array(base), pa.array(price), size, tail], ["rid", "doc_id", "fold", "n_tokens", "n_known", "base", "score", "size", "tail"])

    numbered = docs.withColumn("rid", F.monotonically_increasing_id()).select("rid", "doc_id", F.col("fold").cast("long").alias("fold"), "text")
    rows = written(numbered.mapInArrow(lean(score), "rid long, doc_id long, fold long, n_tokens long, n_known long, base double, score double, size long, tail array<long>"))
    rare = rows.select("rid", F.explode("tail").alias("h")).groupBy("rid", "h").agg(F.count("*").alias("n"))
    more = rare.join(counts, "h").groupBy("rid").agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("more"))
    out = rows.drop("tail").join(more, "rid", "left")
    return out.select(
        "doc_id", (F.col("fold") == HELD_OUT).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score", F.try_divide(-F.col("score") * math.log2(10), "size").alias("bits_per_byte"),
    )


def op2_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(read(spark, sf_dir, "documents"))


QUERIES = {"op2_context_mixing": op2_context_mixing}
SQL: dict[str, str] = {}
