"""Alignment of two tokenizers' tokens over the same bytes, and how often their ids meet.

Method. Both tokenizers read a blank and the text. Tokens are laid out by the bytes of their ids. In each
Arrow batch pandas.merge_asof, keyed by document, finds for each token start of one side the other side's
covering token; the union of both directions holds all overlaps. Where an overlap's two tokens end
together, a group ends. A document's links are, group by group, each A token with each B token; they
are kept as distinct id pairs with multiplicities, built in chunks, so no product of a group is ever held
whole. How many documents hold a pair is a Spark aggregate. The pairs that most documents hold (at most
HOT_PAIRS, a fixed size) go to the tasks as a table; all others meet their counts by an equi-join. Which of
both ways a pair takes changes no result, and pairs that nearly every document holds are never shuffled.

Texts are cut before blanks that stand alone between two visible characters, where neither tokenizer can
join what is left and right; each distinct chunk is encoded once a slice, many in a row. A is encoded by its own
vocabulary as merge ranks (tiktoken) where its merges make ids in rising order, else by its own library. In each slice
the text of middle length is encoded whole by the files' own libraries; a difference fails the query.

Special tokens' strings in a text are plain text. Texts that are null or empty, or whose joined bytes on
either side differ from blank + text, have no tokens: zeros and an empty groups text. Texts are
aligned whole, however long. Repeated rows and ids, null ids included, are documents of their own. Of the
input only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import read, written
from ._text import pieces, utf8
from .sentencepiece_codec import MARKER, MODEL, file_bytes, parse, piece_bytes

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
#: Bytes of text that are encoded at once, and aligned at once; at least one text.
SLICE, STEP = 4 << 20, 1 << 20
#: Bytes of distinct chunks that are encoded in a row.
RUN = 1 << 11
#: Id pairs of links that are built at once.
PAIRS = 1 << 20
#: Rows of the table of frequent pairs that goes to the tasks.
HOT_PAIRS = 1 << 18
#: Fixed value: how this kind of tokenizer cuts texts into words before it merges.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Side:
    """One tokenizer: ids of texts that begin with a blank, ids of whole texts by the file's own library, bytes of ids."""

    size: np.ndarray
    table: list[bytes]

    def encode(self, texts: list[bytes]) -> list[list[int]]:
        raise NotImplementedError

    def whole(self, text: str) -> list[int]:
        """What the file's own library makes of blank + text."""
        raise NotImplementedError

    def joined(self, ids) -> bytes:
        return b"".join([self.table[i] for i in ids])


class ByteSide(Side):
    def __init__(self, raw: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw.decode())
        self.tokenizer.encode_special_tokens = True
        file = json.loads(raw)
        letters = byte_letters()
        vocabulary = file["model"]["vocab"]
        special = {x["content"]: x["id"] for x in file["added_tokens"]}
        n = max([*vocabulary.values(), *special.values()]) + 1
        self.table = [b""] * n
        for piece, i in vocabulary.items():
            self.table[i] = piece.encode() if piece in special else bytes(letters[c] for c in piece)
        self.size = np.array([len(x) for x in self.table], np.int64)
        made = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in file["model"]["merges"]]
        step = file.get("pre_tokenizer") or {}
        self.ranks = None
        if all(a < b for a, b in zip(made, made[1:])) and file.get("normalizer") is None and step.get("type") == "ByteLevel" and step.get("use_regex", True) and not step.get("add_prefix_space"):
            import tiktoken

            ranks = {self.table[i]: i for p, i in vocabulary.items() if p not in special}
            self.ranks = tiktoken.Encoding("side", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts):
        texts = [x.decode() for x in texts]
        if self.ranks:
            return [self.ranks.encode_ordinary(x) for x in texts]
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def whole(self, text):
        return self.tokenizer.encode(" " + text, add_special_tokens=False).ids


class PieceSide(Side):
    def __init__(self, raw: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        data, at = piece_bytes(raw)
        self.table = [data[lo:hi].tobytes() for lo, hi in zip(at[:-1], at[1:])]
        self.size = np.diff(at).astype(np.int64)
        m = parse(raw)
        self.cut = m["dummy_prefix"] and not m["trim_spaces"] and not m["charsmap"] and not any(MARKER in p.lstrip(MARKER) for p, _, _ in m["pieces"])
        self.blank = self.model.piece_to_id(MARKER)

    def encode(self, texts):
        # the model puts the first blank back; of an empty text it makes nothing
        found = self.model.encode([x[1:].decode() for x in texts], num_threads=1)
        return [[self.blank] if x == b" " else ids for x, ids in zip(texts, found)]

    def whole(self, text):
        return self.model.encode(text)


def _ends_seen(last, lead):
    """Whether a character with this last byte, and this byte before it, is surely no white space; three or four bytes aren't told."""
    return ((last > 0x20) & (last < 0x7F)) | ((last >= 0x80) & (lead >= 0xC3) & (lead <= 0xDF))


def _starts_seen(byte):
    return ((byte > 0x20) & (byte < 0x7F)) | ((byte >= 0xC3) & ~np.isin(byte, [0xE1, 0xE2, 0xE3]))


def cuts(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where chunks start in bytes of texts that each begin with a blank at `first`: there, and before
    blanks between two visible characters. After characters of three or four bytes, and before those that may be
    white space, nothing is cut."""
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 1) & (at + 1 < len(data))]
    start = np.zeros(len(data), bool)
    start[at[_ends_seen(data[at - 1], data[at - 2]) & _starts_seen(data[at + 1])]] = True
    start[first] = True
    return np.flatnonzero(start)


class Coded:
    """Ids of distinct chunks: for each side flat ids, each chunk's first place and number of ids in them; fit: whether
    both sides' bytes are the chunk's."""

    def __init__(self, sides: tuple[Side, Side], words: pa.Array, cut: bool):
        chunks = words.to_pylist()
        data = np.frombuffer(words.buffers()[2], np.uint8)
        at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        lens = np.diff(at)
        # chunks that may stand in a row: both ends are places where texts are cut
        plain = (lens > 1) & cut
        k = np.flatnonzero(plain)
        plain[k] = _starts_seen(data[at[k] + 1]) & _ends_seen(data[at[k + 1] - 1], data[at[k + 1] - 2])
        k = np.flatnonzero(plain)
        done = np.cumsum(lens[k])
        runs = np.split(k, np.flatnonzero(np.diff(done // RUN)) + 1) if len(k) else []
        texts = [b"".join([chunks[i] for i in run.tolist()]) for run in runs]
        found = [side.encode(texts) for side in sides]
        fine = [all(side.joined(ids[r]) == text for side, ids in zip(sides, found)) for r, text in enumerate(texts)]
        rest = [np.flatnonzero(~plain)]
        inside: list[np.ndarray] = []
        for r, run in enumerate(runs):
            (inside if fine[r] else rest).append(run)
        inside = np.concatenate([np.zeros(0, np.int64), *inside])
        rest = np.concatenate(rest)
        ends = np.cumsum(lens[inside])
        alone = [side.encode([chunks[i] for i in rest.tolist()]) for side in sides]
        self.fit = np.ones(len(chunks), bool)
        self.fit[rest] = [all(side.joined(ids[j]) == chunks[i] for side, ids in zip(sides, alone)) for j, i in enumerate(rest.tolist())]
        self.flat, self.base, self.count = [], [], []
        for side, ids, own in zip(sides, found, alone):
            flat = np.array([t for r, x in enumerate(ids) if fine[r] for t in x], np.int64)
            token_ends = np.cumsum(side.size[flat])
            to = np.searchsorted(token_ends, ends)
            if len(ends) and not (token_ends[to] == ends).all():
                raise ValueError("a token reaches over a place where texts are cut")
            base, count = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
            count[inside] = np.diff(np.concatenate([[0], to + 1]))
            base[inside] = to + 1 - count[inside]
            n = np.array([len(x) for x in own], np.int64)
            count[rest] = n
            base[rest] = len(flat) + np.cumsum(n) - n
            self.flat.append(np.concatenate([flat, np.array([t for x in own for t in x], np.int64)]))
            self.base.append(base)
            self.count.append(count)

    def ids(self, side: int, chunks: np.ndarray) -> np.ndarray:
        """The ids of chunks in a row."""
        n = self.count[side][chunks]
        shift = self.base[side][chunks] - (np.cumsum(n) - n)
        return self.flat[side][np.repeat(shift, n) + np.arange(n.sum())]


def encoded(sides: tuple[ByteSide, PieceSide], column):
    """For a string column: a's ids, the n + 1 offsets of rows in them, b's ids, their offsets. Rows without tokens have none."""
    raw, offsets = utf8(column)
    lens = np.diff(offsets)
    rows = np.flatnonzero(lens)
    n = len(column)
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    first = offsets[rows] + np.arange(len(rows))
    data = np.insert(raw, offsets[rows], 0x20)
    starts = cuts(data, first) if sides[1].cut else first
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)])
    distinct = words.dictionary_encode()
    at = distinct.indices.to_numpy()
    coded = Coded(sides, distinct.dictionary, sides[1].cut)
    from_ = np.append(np.searchsorted(starts, first), len(starts))
    row_of = np.repeat(np.arange(len(rows)), np.diff(from_))
    fit = np.ones(len(rows), bool)
    for i in sorted(set(row_of[~coded.fit[at]].tolist())):
        # a chunk's bytes differ: the whole text decides
        mine, text = at[from_[i] : from_[i + 1]], data[first[i] : first[i] + lens[rows[i]] + 1].tobytes()
        fit[i] = all(side.joined(coded.ids(j, mine).tolist()) == text for j, side in enumerate(sides))
    kept = np.flatnonzero(fit)
    if len(kept):
        i = int(kept[np.argsort(lens[rows[kept]], kind="stable")[len(kept) // 2]])
        text, mine = column[int(rows[i])].as_py(), at[from_[i] : from_[i + 1]]
        for j, side in enumerate(sides):
            if coded.ids(j, mine).tolist() != side.whole(text):
                raise ValueError(f"ids of the chunks differ from those of the whole text for {text[:200]!r}")
    at, row_of = at[fit[row_of]], row_of[fit[row_of]]
    out = []
    for j in (0, 1):
        per_row = np.bincount(rows[row_of], coded.count[j][at], n).astype(np.int64)
        out += [coded.ids(j, at), np.concatenate([[0], np.cumsum(per_row)])]
    return out


def overlaps(a_at, b_at, a_size, b_size) -> tuple[pd.DataFrame, pd.DataFrame, pd.DataFrame]:
    """Tokens of both sides (row, start, end) and all overlapping pairs (a, b), by two as-of joins keyed by row.

    a_at, b_at: offsets of rows in the tokens; a_size, b_size: bytes of tokens. Both sides of a row have the same bytes."""
    sides = []
    for name, at, size in (("a", a_at, a_size), ("b", b_at, b_size)):
        end = np.cumsum(size)
        sides.append(pd.DataFrame({"start": end - size, "row": np.repeat(np.arange(len(at) - 1), np.diff(at)), name: np.arange(len(size)), f"{name}_end": end}))
    a, b = sides
    both = pd.concat([pd.merge_asof(a, b, on="start", by="row"), pd.merge_asof(b, a, on="start", by="row")])
    return a, b, both


def groups(a: pd.DataFrame, b: pd.DataFrame, both: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The group of every A and B token, numbered through the slice, and the row of each group."""
    closes = np.zeros(len(a), bool)
    closes[both["a"].to_numpy()[both["a_end"].to_numpy() == both["b_end"].to_numpy()]] = True
    ends = a["a_end"].to_numpy()[closes]
    of_a = np.cumsum(closes) - closes
    of_b = np.searchsorted(ends, b["start"].to_numpy(), "right")
    return of_a, of_b, a["row"].to_numpy()[closes]


@lru_cache(1)
def _decimals(most: int) -> tuple[np.ndarray, np.ndarray]:
    """ASCII digits of 0 to most from the left, with room for a mark, and their numbers of digits."""
    text = [str(i) for i in range(most + 1)]
    wide = len(text[-1]) + 1
    return np.frombuffer("".join([x.ljust(wide) for x in text]).encode(), np.uint8).reshape(-1, wide), np.array([len(x) for x in text])


def group_texts(ids_a, of_a, ids_b, of_b, row, n: int, decimals) -> list[str]:
    """For each of n rows the SHA-256 of its groups, written as `a1,a2|b1;a3|b2`; '' without tokens."""
    if not len(ids_a):
        return [""] * n
    n_a, n_b = np.bincount(of_a, minlength=len(row)), np.bincount(of_b, minlength=len(row))
    before_a, before_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    place_a, place_b = np.arange(len(of_a)) + before_b[of_a], np.arange(len(of_b)) + (before_a + n_a)[of_b]
    ids, mark = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
    ids[place_a], ids[place_b] = ids_a, ids_b
    last_b = before_a + n_a + before_b + n_b - 1
    mark[last_b - n_b], mark[last_b] = ord("|"), ord(";")
    digits, size = decimals[0][ids], decimals[1][ids]
    digits[np.arange(len(ids)), size] = mark
    text = digits[np.arange(digits.shape[1])[None, :] <= size[:, None]].tobytes()
    ends = np.cumsum(size + 1)
    to = np.concatenate([[0], ends[last_b]])[np.searchsorted(row, np.arange(n + 1))].tolist()
    # the last mark of a row isn't part of its text
    return [hashlib.sha256(text[lo : hi - 1]).hexdigest() if hi > lo else "" for lo, hi in zip(to[:-1], to[1:])]


def linked(ids_a, of_a, ids_b, of_b, row) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row, A id, B id and multiplicity of links, in chunks of about PAIRS; a pair may come up in several groups of a row."""
    # groups of one token on both sides are most of all
    one = (np.bincount(of_a, minlength=len(row)) == 1) & (np.bincount(of_b, minlength=len(row)) == 1)
    in_a, in_b = one[of_a], one[of_b]
    yield row[of_a[in_a]], ids_a[in_a], ids_b[in_b], np.ones(in_a.sum(), np.int64)

    def counted(of, ids):
        key, n = np.unique(of << 32 | ids, return_counts=True)
        return key >> 32, key & 0xFFFFFFFF, n

    ga, a, na = counted(of_a[~in_a], ids_a[~in_a])
    gb, b, nb = counted(of_b[~in_b], ids_b[~in_b])
    lo, hi = np.searchsorted(gb, ga, "left"), np.searchsorted(gb, ga, "right")
    size = hi - lo
    done = np.cumsum(size)
    at = 0
    while at < len(ga):
        base = done[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(done, base + PAIRS, "right")))
        s = size[at:to]
        left = np.repeat(np.arange(at, to), s)
        right = np.repeat(lo[at:to] - (np.cumsum(s) - s), s) + np.arange(s.sum())
        yield row[ga[left]], a[left], b[right], na[left] * nb[right]
        at = to


def distinct_links(ids_a, of_a, ids_b, of_b, row, n: int):
    """Offsets of n rows in their distinct id pairs (A id << 32 | B id), the pairs, their multiplicities."""
    found: list[tuple] = []
    kept = 0
    # row, A id and B id in one key where they have room
    narrow = max(ids_a.max(initial=0), ids_b.max(initial=0)) < 1 << 20 and n < 1 << 23

    def compact() -> tuple:
        rows, pair, weight = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*found) if found else ([], [], [])))
        order = np.argsort(rows << 40 | pair >> 32 << 20 | pair & 0xFFFFFFFF) if narrow else np.lexsort((pair, rows))
        rows, pair, weight = rows[order], pair[order], weight[order]
        new = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (pair[1:] != pair[:-1]))[: len(rows)])
        return rows[new], pair[new], np.add.reduceat(weight, new) if len(new) else weight

    for r, a, b, w in linked(ids_a, of_a, ids_b, of_b, row):
        found.append((r, a << 32 | b, w))
        if sum(len(x[0]) for x in found) > 4 * PAIRS + 2 * kept:
            found = [compact()]
            kept = len(found[0][0])
    rows, pair, weight = compact()
    return np.searchsorted(rows, np.arange(n + 1)), pair, weight


def _sides(spark: SparkSession, a_path: str, b_path: str):
    return spark.sparkContext.broadcast((file_bytes(spark, a_path), file_bytes(spark, b_path)))


@lru_cache(1)
def _loaded(a: bytes, b: bytes) -> tuple[ByteSide, PieceSide]:
    """Both sides, read once by each worker."""
    return ByteSide(a), PieceSide(b)


def _slices(batches, shared):
    """Rows of Arrow batches with the ids of both sides and their groups."""
    os.environ |= {"RAYON_NUM_THREADS": "1", "TOKENIZERS_PARALLELISM": "false"}
    sides = _loaded(*shared.value)
    for batch in batches:
        for large in pieces(batch, "text", SLICE):
            all_a, at_a, all_b, at_b = encoded(sides, large.column("text"))
            lo = 0
            for part in pieces(large, "text", STEP):
                hi = lo + part.num_rows
                ids_a, ids_b = all_a[at_a[lo] : at_a[hi]], all_b[at_b[lo] : at_b[hi]]
                a_at, b_at = at_a[lo : hi + 1] - at_a[lo], at_b[lo : hi + 1] - at_b[lo]
                a, b, both = overlaps(a_at, b_at, sides[0].size[ids_a], sides[1].size[ids_b])
                yield part, ids_a, a_at, ids_b, b_at, a, b, both, *groups(a, b, both)
                lo = hi


def aligned(docs: DataFrame, a_path: str = BYTE_MODEL, b_path: str = MODEL) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256 of each row, and its distinct links: pairs (array of
    A id << 32 | B id, rising) and times (how often each is linked)."""
    shared = _sides(docs.sparkSession, a_path, b_path)

    def align(batches):
        decimals = _decimals(1 << 17)
        for part, ids_a, a_at, ids_b, b_at, _, _, _, of_a, of_b, row in _slices(batches, shared):
            n = part.num_rows
            at, pair, times = distinct_links(ids_a, of_a, ids_b, of_b, row, n)
            in_a, in_b = np.bincount(of_a, minlength=len(row)), np.bincount(of_b, minlength=len(row))
            # sums of longs stay exact: no float weights
            links = np.zeros(n, np.int64)
            np.add.at(links, row, in_a * in_b)
            lists = lambda x, at=at: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, pa.int64()))
            columns = [part.column("doc_id"), np.diff(a_at), np.diff(b_at), np.bincount(row, minlength=n), links, group_texts(ids_a, of_a, ids_b, of_b, row, n, decimals), lists(pair), lists(times)]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(align, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>")


def token_overlaps(docs: DataFrame, a_path: str = BYTE_MODEL, b_path: str = MODEL) -> DataFrame:
    """All overlapping tokens: doc_id, a_index, b_index (from 0 in the document), a_id, b_id, group (from 0 in the
    document), ends_group: whether both end there."""
    shared = _sides(docs.sparkSession, a_path, b_path)

    def find(batches):
        for part, ids_a, a_at, ids_b, b_at, _, _, both, of_a, _, row in _slices(batches, shared):
            both = both.drop_duplicates(["a", "b"]).sort_values(["a", "b"])
            a, b, r = both["a"].to_numpy(), both["b"].to_numpy(), both["row"].to_numpy()
            columns = [part.column("doc_id").take(pa.array(r)), a - a_at[r], b - b_at[r], ids_a[a], ids_b[b], of_a[a] - np.searchsorted(row, r), both["a_end"].to_numpy() == both["b_end"].to_numpy()]
            names = ["doc_id", "a_index", "b_index", "a_id", "b_id", "group", "ends_group"]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(find, "doc_id long, a_index long, b_index long, a_id long, b_id long, group long, ends_group boolean")


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, count (rows that hold it) and best: whether no pair of its A id has a larger count."""
    counts = written(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count")))
    a = F.shiftright("pair", 32)
    highest = counts.groupBy(a.alias("a")).agg(F.max("count").alias("highest"))
    # a row for each id of A's vocabulary
    return counts.join(F.broadcast(highest), a == F.col("a")).select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def frequent(counts: DataFrame, most: int = HOT_PAIRS):
    """The pairs that most rows hold, at most `most`, as sorted arrays; how many is found from a histogram of fixed size."""
    bin_ = F.floor(F.log2("count") * 16).cast("int")
    bins = counts.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n")).orderBy(F.desc("bin")).collect()
    total, least = 0, None
    for r in bins:
        total += r.n
        if total > most:
            break
        least = r.bin
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    hot = counts.where(bin_ >= least).toPandas().sort_values("pair")
    return hot["pair"].to_numpy(np.int64), hot["count"].to_numpy(np.int64), hot["best"].to_numpy(bool)


def with_counts(rows: DataFrame, counts: DataFrame, most: int = HOT_PAIRS) -> DataFrame:
    """rows (of `aligned`, written) without their links, with n_best and count_sum."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent(counts, most))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def split(batches):
        hot, count, best = shared.value
        for batch in batches:
            pair, times = (batch.column(c).flatten().to_numpy() for c in ("pairs", "times"))
            size = np.diff(batch.column("pairs").offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), size)
            at = np.minimum(np.searchsorted(hot, pair), max(len(hot) - 1, 0))
            known = hot[at] == pair if len(hot) else np.zeros(len(pair), bool)
            n_best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            r, k, w = row[known], at[known], times[known]
            np.add.at(total, r, w * count[k])
            np.add.at(n_best, r, w * best[k])
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[~known], minlength=batch.num_rows))]), pa.int32())
            rest = [pa.ListArray.from_arrays(offsets, pa.array(x[~known], pa.int64())) for x in (pair, times)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ["row", *names]], pa.array(n_best), pa.array(total), *rest], ["row", *names, "n_best", "count_sum", "pairs", "times"])

    kinds = dict(rows.dtypes)
    schema = ", ".join(["row long", *[f"{c} {kinds[c]}" for c in names], "n_best long, count_sum long, pairs array<long>, times array<long>"])
    # numbers of rows stay with the rows, as the table is written
    known = written(rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(split, schema))
    rare = known.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    found = rare.join(counts, "pair").groupBy("row").agg(F.sum(F.col("n") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("n") * F.col("count")).alias("more_sum"))
    out = known.select("row", *names, "n_best", "count_sum").join(found, "row", "left")
    return out.select(*names, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))


def alignment(docs: DataFrame, a_path: str = BYTE_MODEL, b_path: str = MODEL) -> DataFrame:
    """One row a document: sizes and digest of its groups, links, and how its links stand in all documents."""
    rows = written(aligned(docs, a_path, b_path))
    return with_counts(rows, written(pair_counts(rows)))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(read(spark, sf_dir, "documents"))


QUERIES = {"op13_tokenizer_alignment": op13_tokenizer_alignment}
SQL: dict[str, str] = {}
