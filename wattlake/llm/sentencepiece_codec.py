"""SentencePiece encoding and decoding with the tokenizers library as backend.

Method. The model's protobuf is read by its wire format: pieces with scores and types, model type,
normaliser and flags. From them a tokenizers pipeline is rebuilt: the precompiled character map, the
white-space rules, the metaspace marker, unigram scores or, for a BPE model, merges ranked by the
score of the piece they make, byte fallback, and the decoder. Where no piece holds a marker after
another character, texts may be cut before markers without changing a result, which keeps the work
linear in long texts. The rebuilt pipeline goes to the tasks as one JSON string; batches are
encoded with the library's own threads, as many as spark.task.cpus. Ids are decoded by joining the bytes
of their pieces (what the rebuilt decoder does, many texts at once). In every slice of a batch the text of
middle length is the probe: its ids are held against the sentencepiece library itself, and its decoding
against the rebuilt decoder; a difference fails the query.

Null and empty texts have no ids and decode to an empty text. Texts are encoded whole. Other columns
pass through `encoded`; those of the names that it adds are replaced. Control pieces written out in a text are ordinary text.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import read
from ._runs import lean
from ._text import pieces as slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
#: Fixed values of the model format: field numbers and types.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Bytes of text that a task encodes at once; encodings of a slice take some forty times its size.
SLICE = 1 << 18
#: What `encoded` adds.
ADDED = ("ids", "n_tokens", "ids_crc32", "round_trip")


def fields(raw: bytes) -> dict[int, list]:
    """The fields of a protobuf message: numbers, or bytes for all that has a length."""
    out: dict[int, list] = {}
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value = varint()
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value = struct.unpack("<d" if kind == 1 else "<f", raw[at : at + size])[0]
            at += size
        else:
            size = varint()
            value = raw[at : at + size]
            at += size
        out.setdefault(tag >> 3, []).append(value)
    return out


def parse(raw: bytes) -> dict:
    """What encoding needs of a model file."""
    top = fields(raw)
    trainer, norm = fields(top[2][0]), fields(top.get(3, [b""])[0])
    found = [fields(x) for x in top[1]]
    return {
        "pieces": [(p[1][0].decode(), p.get(2, [0.0])[0], p.get(3, [NORMAL])[0]) for p in found],
        "kind": trainer.get(3, [UNIGRAM])[0],
        "byte_fallback": bool(trainer.get(35, [0])[0]),
        "charsmap": norm.get(2, [b""])[0],
        "dummy_prefix": bool(norm.get(3, [1])[0]),
        "trim_spaces": bool(norm.get(4, [1])[0]),
    }


def merges(pieces: list) -> list[tuple[str, str]]:
    """Every way to make a piece of two others, in the order of falling scores of what they make."""
    usable = {p for p, _, kind in pieces if kind in (NORMAL, USER)}
    made = []
    for i, (p, score, kind) in enumerate(pieces):
        if kind == NORMAL:
            made += [(-score, i, k, p) for k in range(1, len(p)) if p[:k] in usable and p[k:] in usable]
    return [(p[:k], p[k:]) for _, _, k, p in sorted(made)]


def rebuild(raw: bytes):
    """A tokenizers pipeline that encodes and decodes as the model does."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    m = parse(raw)
    unknown = next((i for i, p in enumerate(m["pieces"]) if p[2] == UNKNOWN), None)
    if m["kind"] == UNIGRAM:
        model = models.Unigram([(p, s) for p, s, _ in m["pieces"]], unk_id=unknown, byte_fallback=m["byte_fallback"])
    elif m["kind"] == BPE:
        model = models.BPE(vocab={p: i for i, (p, _, _) in enumerate(m["pieces"])}, merges=merges(m["pieces"]), unk_token=m["pieces"][unknown][0] if unknown is not None else None, fuse_unk=True, byte_fallback=m["byte_fallback"])
    else:
        raise ValueError(f"model type {m['kind']} is neither unigram nor BPE")
    out = Tokenizer(model)
    steps = [normalizers.Precompiled(m["charsmap"])] if m["charsmap"] else []
    if m["trim_spaces"]:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if m["dummy_prefix"]:
        steps.append(normalizers.Prepend(MARKER))
    out.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARKER)])
    if not any(MARKER in p.lstrip(MARKER) for p, _, kind in m["pieces"] if kind in (NORMAL, USER)):
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"(?<=[^{MARKER}]){MARKER}"), "merged_with_next")
    tail = [decoders.Strip(" ", 1, 0)] if m["dummy_prefix"] else []
    out.decoder = decoders.Sequence([decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse(), *tail])
    return out


def piece_bytes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that all ids decode to, in a row, and the n + 1 offsets of ids in them."""
    found = []
    for piece, _, kind in parse(raw)["pieces"]:
        found.append(bytes([int(piece[3:-1], 16)]) if kind == BYTE else piece.replace(MARKER, " ").encode())
    return np.frombuffer(b"".join(found), np.uint8), np.cumsum([0, *map(len, found)])


class Joiner:
    """Decodes lists of ids by joining the bytes of their pieces."""

    def __init__(self, raw: bytes):
        self.data, self.at = piece_bytes(raw)
        self.size = np.diff(self.at)
        self.trim = parse(raw)["dummy_prefix"]

    def texts(self, flat: np.ndarray, at: np.ndarray) -> list[bytes]:
        """The bytes of each text, whose ids are flat[at[i]:at[i + 1]]."""
        n = self.size[flat]
        ends = np.cumsum(n)
        shift = np.repeat(self.at[flat] - (ends - n), n)
        raw = self.data[shift + np.arange(len(shift))].tobytes()
        cut = np.concatenate([[0], ends])[at]
        found = [raw[lo:hi] for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist())]
        return [x[1:] if x[:1] == b" " else x for x in found] if self.trim else found


def file_bytes(spark: SparkSession, path: str) -> bytes:
    """A model file, read by Spark where the driver has no such file of its own."""
    if os.path.exists(path):
        with open(path, "rb") as f:
            return f.read()
    return bytes(spark.read.format("binaryFile").load(path).first()["content"])


def encoded(docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """docs with ids (array of int), n_tokens and round_trip: whether the ids decode to the text."""
    spark = docs.sparkSession
    raw = file_bytes(spark, model_path)
    shared = spark.sparkContext.broadcast((raw, rebuild(raw).to_str()))
    threads = spark.conf.get("spark.task.cpus", "1")
    docs = docs.select([F.col(f"`{c}`") for c in docs.columns if c not in ADDED])
    names = docs.columns

    def encode(batches):
        os.environ |= {"RAYON_NUM_THREADS": threads, "TOKENIZERS_PARALLELISM": "true" if int(threads) > 1 else "false"}
        import sentencepiece
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(shared.value[1])
        reference = sentencepiece.SentencePieceProcessor(model_proto=shared.value[0])
        joiner = Joiner(shared.value[0])
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts = [x or "" for x in part.column("text").to_pylist()]
                ids = [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
                at = np.cumsum([0, *map(len, ids)])
                flat = np.concatenate([np.asarray(x, np.int32) for x in ids])
                back = joiner.texts(flat, at)
                probe = sorted(range(len(texts)), key=lambda i: len(texts[i]))[len(texts) // 2]
                if ids[probe] != reference.encode(texts[probe]):
                    raise ValueError(f"ids of the rebuilt tokenizer differ from the model's own for {texts[probe][:200]!r}")
                if back[probe].decode(errors="replace") != tokenizer.decode(ids[probe], skip_special_tokens=False):
                    raise ValueError(f"ids decode otherwise than by the rebuilt decoder for {texts[probe][:200]!r}")
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))
                crc = [zlib.crc32(flat[lo:hi].astype("<i4").tobytes()) for lo, hi in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array([len(x) for x in ids], pa.int64()), pa.array(crc, pa.int64()), pa.array([a.encode() == b for a, b in zip(texts, back)], pa.bool_())], [*names, *ADDED])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ["ids array<int>", "n_tokens long", "ids_crc32 long", "round_trip boolean"])
    return docs.mapInArrow(lean(encode), schema)


def decoded(rows: DataFrame, model_path: str = MODEL) -> DataFrame:
    """rows with `decoded`: the text of their `ids` (array of int); null ids decode to an empty text, bytes that
    are no UTF-8 to the replacement character. Ids outside the model fail."""
    raw = file_bytes(rows.sparkSession, model_path)
    shared = rows.sparkSession.sparkContext.broadcast(raw)
    names = [c for c in rows.columns if c != "decoded"]
    rows = rows.select(names)

    def decode(batches):
        joiner = Joiner(shared.value)
        for batch in batches:
            lists = batch.column("ids")
            size = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
            texts = joiner.texts(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(size)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x.decode(errors="replace") for x in texts], pa.string())], [*names, "decoded"])

    return rows.mapInArrow(decode, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + ["decoded string"]))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens", "ids_crc32", "round_trip")


QUERIES = {"op5_sentencepiece": op5_sentencepiece}
SQL: dict[str, str] = {}
