"""Toxicity of restored text: a noisy channel undoes obfuscation, then a classifier scores.

Method. (1) A character trigram model over byte classes is counted on all documents. (2) Spans that may
be obfuscated (letters mixed with look-alike signs, letters spaced out, runs of three of a letter) become
lattices: each sign keeps itself or becomes a letter it resembles, separators may vanish, runs may
shrink; Viterbi decoding picks the path of the best language-model plus channel score. (3) Features are
the words of the restored text and their beginnings of PREFIXES bytes, each once a document. Labelled
training documents, about FIT_LABELS at most (those of the smallest hash; the bound is this parameter),
say how often each occurs in either class; the FEATURES of the highest log odds are kept. (4) A logistic
regression on a document's highest log odds, fitted on about FIT_ROWS of these documents, gives the score.

Only labels of documents with crc32(doc_id as text) mod 5 not 0 are used; labels, language, source and
id are no inputs of a score. Null and empty texts have no feature and get the score of no evidence.
Without labelled rows of both kinds every score is 0. Documents that repeat an id score each by its own
text. Texts are scored whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import drop_written, read, written
from ._runs import lean
from ._tables import summed_table
from ._text import LOWER, mix, pieces, powers, utf8

FOLDS = 5
PREFIXES = (4, 5, 6, 7)
FEATURES = 1 << 17
LEAST_TOXIC = 4
#: The bounded sample of labelled rows that the classifier is fitted on, and the part that its regression takes.
FIT_LABELS = 1 << 18
FIT_ROWS = 20_000
#: Slots of the filter of candidate features.
FILTER_BITS = 22
#: Letters that a sign may stand for.
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "(": "c", "<": "c"}
SEPARATORS = " .-_*'~,/\\"
#: Channel costs (negative log probabilities) of a substitution (or of a digit that is meant, as likely
#: inside a word), a run that shrinks, a separator or sign that stays. A separator that goes is free.
SUBSTITUTED, SHRUNK, STAYED = 2.0, 1.0, 4.0
#: Letters spaced out; what is suspect inside a token; bytes that may stand before and after that in its span.
SPACED = re.compile(rb"(?<![A-Za-z0-9])[A-Za-z0-9@$!|](?:[ .\-_*'~,/\\]{1,2}[A-Za-z0-9@$!|](?![A-Za-z0-9\x80-\xff])){2,}")
_CORE = rb"[A-Za-z][0-9@$!|+(<]+[A-Za-z]|(?<![^\s])[@$!|0-9]+[A-Za-z]{2}|[A-Za-z]{2}[0-9@$|]+(?=\s|$)|([A-Za-z])\1\1|[A-Za-z][*._\-][A-Za-z][*._\-][A-Za-z]"
CORE = re.compile(rb"(?=(" + _CORE.replace(rb"\1\1", rb"\2\2") + rb"))")
BEFORE = re.compile(rb"[A-Za-z0-9@$!|+\x80-\xff]+")
AFTER = re.compile(rb"[A-Za-z0-9@$!|+*._\-\x80-\xff]*")
#: Longest span that is remembered once decoded; longer ones are decoded each time.
LONGEST_KNOWN = 64
CLASSES = 64
#: Byte classes: a to z are 1 to 26, digits 27 to 36, bytes over 127 share 37 to 62, the rest is 0.
CLASS = np.zeros(256, np.int64)
CLASS[97:123] = np.arange(1, 27)
CLASS[65:91] = np.arange(1, 27)
CLASS[48:58] = np.arange(27, 37)
CLASS[128:] = 37 + np.arange(128) % 26
#: What a byte can be, as bits.
LETTER, SIGN, BLANK, IN_WORD = 1, 2, 4, 8
BYTE_KIND = np.zeros(256, np.uint8)
BYTE_KIND[[*range(65, 91), *range(97, 123)]] |= LETTER
BYTE_KIND[list(b"0123456789@$!|+(<")] |= SIGN
BYTE_KIND[[0x20, *range(0x09, 0x0E)]] |= BLANK
BYTE_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] |= IN_WORD
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def character_model(docs: DataFrame) -> np.ndarray:
    """Negative log probabilities of a byte class after two others, from all documents' texts."""

    def update(total, batch):
        for p in pieces(batch, "text", 1 << 20):
            data, offsets = utf8(p.column("text"))
            if len(data) > 2:
                c = CLASS[data]
                total += np.bincount(c[:-2] * CLASSES**2 + c[1:-1] * CLASSES + c[2:], minlength=CLASSES**3)

    n = summed_table(docs.select("text"), CLASSES**3, update).reshape(CLASSES, CLASSES, CLASSES).astype(np.float64)
    one = (n.sum(axis=(0, 1)) + 1) / (n.sum() + CLASSES)
    two = n.sum(axis=0)
    two = (two + 8 * one) / (two.sum(axis=1, keepdims=True) + 8)
    return -np.log((n + 8 * two) / (n.sum(axis=2, keepdims=True) + 8)).astype(np.float32)


def restore(span: str, cost: np.ndarray) -> str:
    """The likeliest plain text of a span."""
    options, at = [], 0
    while at < len(span):
        ch = span[at].lower()
        run = 1
        while at + run < len(span) and span[at + run].lower() == ch:
            run += 1
        if ch.isalpha() and run >= 2:
            kept = [(ch * run, 0.0), (ch, SHRUNK)] + ([(ch * 2, SHRUNK)] if run > 2 else [])
        elif ch in LOOKALIKES:
            kept = [(ch * run, SUBSTITUTED if ch.isdigit() else STAYED)] + [(x * run, SUBSTITUTED) for x in LOOKALIKES[ch]] + ([(x, SUBSTITUTED + SHRUNK) for x in LOOKALIKES[ch]] if run > 1 else [])
        elif ch in SEPARATORS:
            kept = [(ch * run, STAYED), ("", 0.0)]
        else:
            kept = [(ch * run, 0.0)]
        options.append(kept)
        at += run
    # a path's text is a chain of its parts, so that decoding is linear in the span's length
    paths: dict = {(0, 0): (0.0, None)}
    for kept in [*options, [(" ", 0.0)]]:
        new: dict = {}
        for (a, b), (score, parts) in paths.items():
            for out, price in kept:
                s, x, y = score + price, a, b
                for byte in out.encode():
                    z = int(CLASS[byte])
                    s += float(cost[x, y, z])
                    x, y = y, z
                if (x, y) not in new or s < new[x, y][0]:
                    new[x, y] = (s, (parts, out))
        paths = new
    parts, text = min(paths.values(), key=lambda p: p[0])[1], []
    while parts:
        parts, out = parts
        text.append(out)
    return "".join(reversed(text))[:-1]


def suspect_spans(raw: bytes) -> list[tuple[int, int]]:
    """Where obfuscation may be: letters spaced out, or a token's run of BEFORE up to its last core and what AFTER
    takes behind that; from left to right, at one start letters spaced out first. Linear in the bytes."""
    cores = [(m.start(), m.end(1)) for m in CORE.finditer(raw)]
    spaced = SPACED.search(raw)
    if not cores:
        return [m.span() for m in SPACED.finditer(raw)] if spaced else []
    out, at, k = [], 0, 0
    for run in BEFORE.finditer(raw):
        hi = run.end()
        # a run is left at its end, or earlier by letters spaced out that end inside it
        while at < hi:
            lo = max(run.start(), at)
            while spaced and spaced.start() < at:
                spaced = SPACED.search(raw, at)
            while k < len(cores) and cores[k][0] < lo:
                k += 1
            last = k
            while last < len(cores) and cores[last][0] < hi:
                last += 1
            token = last > k
            if spaced and spaced.start() < hi and (not token or spaced.start() <= lo):
                out.append(spaced.span())
                at = spaced.end()
            elif token:
                at = AFTER.match(raw, cores[last - 1][1]).end()
                out.append((lo, at))
                k = last
            else:
                break
    return out


def suspect_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges, cut at white space, around every place where obfuscation may be."""
    n = len(data)
    if n < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = BYTE_KIND[data]
    pad = np.zeros(4, np.uint8)
    before, after = np.concatenate([pad[:1], kind[:-1]]), np.concatenate([kind[1:], pad[:1]])
    before[offsets[:-1][offsets[:-1] < n]] = 0
    after[offsets[1:][offsets[1:] > 0] - 1] = 0
    sign = (kind & SIGN) > 0
    anchor = sign & ((after & LETTER) > 0) | sign & ((before & LETTER) > 0) & (data != 33)
    low = LOWER[data]
    anchor[2:] |= (low[2:] == low[1:-1]) & (low[2:] == low[:-2]) & ((kind[2:] & LETTER) > 0)
    single = ((kind & IN_WORD) > 0) & ((before & IN_WORD) == 0) & ((after & IN_WORD) == 0)
    near = np.concatenate([single[2:], [False] * 2]) | np.concatenate([single[3:], [False] * 3])
    anchor |= single & near
    at = np.flatnonzero(anchor)
    if not len(at):
        return at, at
    blank = np.concatenate([[-1], np.flatnonzero((kind & BLANK) > 0), [n]])
    starts = blank[np.searchsorted(blank, at, "right") - 1] + 1
    stops = blank[np.searchsorted(blank, np.minimum(at + 4 * single[at], n - 1), "left")]
    # a window stays in its text
    text = np.searchsorted(offsets, at, "right") - 1
    starts, stops = np.maximum(starts, offsets[text]), np.minimum(np.maximum.accumulate(stops), offsets[text + 1])
    new = np.ones(len(at), bool)
    new[1:] = (starts[1:] > stops[:-1] + 1) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return starts[first], np.maximum.reduceat(stops, first)


class Restorer:
    """Restores the suspect spans of texts; decoded spans are remembered, up to a bound."""

    def __init__(self, cost: np.ndarray):
        self.cost, self.known = cost, {}

    def span(self, raw: bytes) -> bytes:
        got = self.known.get(raw)
        if got is None:
            try:
                got = restore(raw.decode(), self.cost).encode()
            except UnicodeDecodeError:
                got = raw
            if len(raw) <= LONGEST_KNOWN and len(self.known) < 100_000:
                self.known[raw] = got
        # what was written stays beside what it was restored to
        return raw if got == raw.lower() else raw + b" " + got

    def window(self, raw: bytes) -> bytes:
        parts, at = [], 0
        for lo, hi in suspect_spans(raw):
            parts += [raw[at:lo], self.span(raw[lo:hi])]
            at = hi
        return b"".join([*parts, raw[at:]]) if parts else raw

    def texts(self, column) -> list[bytes]:
        """The restored texts of a string column. Only tokens around an anchor are looked at closely."""
        data, offsets = utf8(column)
        raw = data.tobytes()
        out = [raw[offsets[i] : offsets[i + 1]] for i in range(len(offsets) - 1)]
        starts, stops = suspect_windows(data, offsets)
        rows = np.searchsorted(offsets, starts, "right") - 1
        for row in np.unique(rows):
            parts, at = [], int(offsets[row])
            for k in np.flatnonzero(rows == row) if len(rows) < 64 else range(np.searchsorted(rows, row), np.searchsorted(rows, row, "right")):
                lo, hi = int(starts[k]), int(min(stops[k], offsets[row + 1]))
                parts += [raw[at:lo], self.window(raw[lo:hi])]
                at = hi
            out[row] = b"".join([*parts, raw[at : offsets[row + 1]]])
        return out


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and of their beginnings, and the index of the text of each."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    ends = np.cumsum([len(x) + 1 for x in texts])
    word = WORD[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    found, rows = [], []
    at = 0
    while at < len(starts):
        lo = starts[at]
        to = max(at + 1, int(np.searchsorted(stops, lo + (1 << 20), "right")))
        hi = stops[to - 1]
        up, down = powers(int(hi - lo) + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((LOWER[data[lo:hi]].astype(np.uint64) + np.uint64(1)) * up[: hi - lo], out=sums[1:])
        s, e = starts[at:to] - lo, stops[at:to] - lo
        row = np.searchsorted(ends, starts[at:to], "right")
        found.append(mix((sums[e] - sums[s]) * down[s]))
        rows.append(row)
        for k in PREFIXES:
            long = np.flatnonzero(e - s > k)
            found.append(mix((sums[s[long] + k] - sums[s[long]]) * down[s[long]] + np.uint64(k)))
            rows.append(row[long])
        at = to
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(rows)


def held_out(doc_id) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0


def feature_counts(docs: DataFrame, cost, bits=None) -> DataFrame:
    """h, n: in how many texts each feature occurs. bits: a broadcast filter that features must pass, or None."""

    def count(batches):
        restorer, held, size = Restorer(cost.value), [], 0
        for batch in batches:
            for p in pieces(batch, "text", 1 << 20):
                f, row = features(restorer.texts(p.column("text")))
                if bits is not None:
                    some = np.flatnonzero(bits.value[(f & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
                    f, row = f[some], row[some]
                _, once = np.unique(mix(f + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
                held.append(f[once])
                size += len(once)
                if size > 1 << 20:
                    yield counted(held)
                    held, size = [], 0
        if size:
            yield counted(held)

    def counted(held):
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_pydict({"h": h.view(np.int64), "n": n.astype(np.int64)})

    return docs.select("text").mapInArrow(lean(count), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def telling_features(labelled: DataFrame, cost, n_clean: int, n_bad: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and log odds of the features that speak most for toxicity. Those in LEAST_TOXIC toxic
    texts at least are candidates; a filter of fixed size thins the clean texts' features before both meet."""
    spark = labelled.sparkSession
    bad = written(feature_counts(labelled.where("toxic = 1"), cost).where(F.col("n") >= LEAST_TOXIC).select("h", F.col("n").alias("bad")))
    slot = F.col("h").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    taken = bad.select(slot.alias("s")).groupBy(F.shiftright("s", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 31 as int))")).alias("v")).toPandas()
    table = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    table[taken["w"].to_numpy(np.int64)] = taken["v"].to_numpy(np.int64).astype(np.uint32)
    bits = spark.sparkContext.broadcast(np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool))
    clean = feature_counts(labelled.where("toxic = 0"), cost, bits).select("h", F.col("n").alias("clean"))
    odds = F.log((F.col("bad") + 0.1) / (n_bad + 1)) - F.log((F.coalesce("clean", F.lit(0)) + 0.5) / (n_clean + 1))
    # what speaks against toxicity is never looked at again
    top = bad.join(clean, "h", "left").select("h", "bad", odds.alias("odds")).where("odds > 0").orderBy(F.desc("odds"), F.desc("bad"), "h").limit(FEATURES).toPandas()
    bits.unpersist()
    h, w = top["h"].to_numpy(np.int64).view(np.uint64), top["odds"].to_numpy(np.float64)
    order = np.argsort(h)
    return h[order], w[order]


class Known:
    """Known features: sorted hashes behind a table that turns away nearly all others."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.table = np.zeros(1 << 22, bool)
        self.table[(hashes & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def hits(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text index, index in hashes) of the known features of texts."""
        f, row = features(texts)
        some = np.flatnonzero(self.table[(f & np.uint64((1 << 22) - 1)).astype(np.int64)])
        f, row = f[some], row[some]
        n = len(self.hashes)
        at = np.minimum(np.searchsorted(self.hashes, f), max(n - 1, 0))
        ok = self.hashes[at] == f if n else np.zeros(len(f), bool)
        pair = np.unique(row[ok].astype(np.int64) * n + at[ok])
        return pair // max(n, 1), pair % max(n, 1)


def evidence(texts: list[bytes], known: Known, odds: np.ndarray) -> np.ndarray:
    """Of each text: its highest log odds, the second, and the sum of the five highest, from 0 up."""
    row, f = known.hits(texts)
    out = np.zeros((len(texts), 3))
    w = odds[f]
    good = w > 0
    row, w = row[good], w[good]
    order = np.lexsort((-w, row))
    row, w = row[order], w[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
    for k in range(2):
        out[row[rank == k], k] = w[rank == k]
    np.add.at(out[:, 2], row[rank < 5], w[rank < 5])
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the intercept comes first."""
    x = np.hstack([np.ones((len(x), 1)), x])
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (y - p) - 0.1 * np.r_[0, b[1:]]
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(b)), grad)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic of about FIT_LABELS labelled training documents (all, if fewer), those of the
    smallest hash. Their ids go to the tasks, which pick the texts out of docs: no text is shuffled."""
    seen = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("long").alias("toxic"))
    seen = seen.where(~held_out(F.col("doc_id")))
    few = smallest_hashes(seen, seen.count(), FIT_LABELS).toPandas().sort_values("doc_id")
    chosen = docs.sparkSession.sparkContext.broadcast((few["doc_id"].to_numpy(np.int64), few["toxic"].to_numpy(np.int64)))

    def pick(batches):
        ids, toxic = chosen.value
        for batch in batches:
            got = batch.column("doc_id").to_numpy()
            at = np.minimum(np.searchsorted(ids, got), max(len(ids) - 1, 0))
            found = np.flatnonzero(ids[at] == got) if len(ids) else np.zeros(0, np.int64)
            if len(found):
                part = batch.take(pa.array(found))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(toxic[at[found]])], ["doc_id", "text", "toxic"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    return written(rows.mapInArrow(pick, "doc_id long, text string, toxic long"))


def smallest_hashes(rows: DataFrame, n: int, wanted: int) -> DataFrame:
    """About `wanted` of n rows, those whose id's hash is smallest; all, if there are no more."""
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int((1 << 40) * wanted / n)) if n > wanted else rows


def fit(docs: DataFrame, labels: DataFrame) -> tuple:
    """The broadcast character costs, known features, log odds and regression weights."""
    spark = docs.sparkSession
    cost = spark.sparkContext.broadcast(character_model(docs))
    labelled = labelled_texts(docs, labels)
    kinds = {r.toxic: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    n_clean, n_bad = kinds.get(0, 0), kinds.get(1, 0)
    if not (n_clean and n_bad):
        return cost, *map(spark.sparkContext.broadcast, (np.zeros(0, np.uint64), np.zeros(0), np.array([-30.0, 0, 0, 0])))
    known, odds = telling_features(labelled, cost, n_clean, n_bad)
    telling_known, weights = spark.sparkContext.broadcast(known), spark.sparkContext.broadcast(odds)

    def measure(batches):
        restorer, found = Restorer(cost.value), Known(telling_known.value)
        for batch in batches:
            for p in pieces(batch, "text", 1 << 20):
                x = evidence(restorer.texts(p.column("text")), found, weights.value)
                yield pa.RecordBatch.from_pydict({"y": p.column("toxic"), **{f"x{j}": x[:, j] for j in range(3)}})

    sample = smallest_hashes(labelled, n_clean + n_bad, FIT_ROWS)
    got = sample.select("text", "toxic").mapInArrow(lean(measure), "y long, x0 double, x1 double, x2 double").toPandas()
    drop_written(labelled)
    beta = fit_logistic(got[["x0", "x1", "x2"]].to_numpy(), got["y"].to_numpy(np.float64))
    return cost, telling_known, weights, spark.sparkContext.broadcast(beta)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with __score (0 to 1) of toxicity; a column of docs with that name is replaced. Documents with a null id are
    scored like others, and none of them is learnt from."""
    cost, known, odds, beta = fit(docs, labels)
    names = [c for c in docs.columns if c != "__score"]
    docs = docs.select([F.col(f"`{c}`") for c in names])

    def score(batches):
        restorer, found = Restorer(cost.value), Known(known.value)
        for batch in batches:
            for p in pieces(batch, "text", 1 << 20):
                x = evidence(restorer.texts(p.column("text")), found, odds.value)
                z = beta.value[0] + x @ beta.value[1:]
                yield pa.RecordBatch.from_arrays([*p.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], [*names, "__score"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ["__score double"])
    return docs.mapInArrow(lean(score), schema)


def op10_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = scored(docs, read(spark, sf_dir, "labels"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op10_noisy_channel_toxicity": op10_noisy_channel_toxicity}
SQL: dict[str, str] = {}
