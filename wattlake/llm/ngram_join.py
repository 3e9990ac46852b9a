"""N-gram Jaccard join: which documents' sets of word shingles overlap by `percent` of their union.

Method. Words are hashed to 64 bits and five neighbours give a shingle hash; a document's set is its
sorted distinct hashes. (1) A table of hashed counts, of fixed size, says how common a shingle is, so
that sets can be ordered rarest first in every task alike. (2) Two sets of the asked similarity share
a member of their first n - ceil(percent*n/100) + 1 in that order: only those become keys, and equal
sets stand for one class. (3) Each class is compared with the one partner that leads most of its keys,
which links whole groups of near copies in linear work. (4) Rows of keys that still hold several
components form tiles, sorted by size; in a tile, sizes and then bit counts of hashed bitmaps
bound the overlap from above, and only pairs that pass are compared by exact intersection of their
sorted arrays. Nothing is capped: large keys are cut into square tiles. A pair is returned by the first key
that both share, not by each.

Null, empty and white-space texts: no shingle, linked with nothing. Texts of one to four words: the
whole sequence is one shingle. Rows are told apart by id and text, so that null and repeated ids are no
hindrance; equal rows repeated give equal result rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import components, read, written
from ._filters import thinned
from ._runs import lean
from ._tables import summed_table
from ._text import mix, pieces, words

N_WORDS = 5
PERCENT = 80
#: Slots of the table of hashed counts; one byte each is broadcast (4 MB whatever the corpus).
COUNT_BITS = 22
#: 64-bit words of a set's bitmap.
BITMAP_WORDS = 16
#: Rows of one side of a tile.
TILE = 2048
#: Ids of several texts that go to the tasks.
ODD_IDS = 1 << 16
#: Pairs that a task holds to return each once.
HELD_PAIRS = 1 << 18
#: Keys before one that a row carries in a tile, so that its pairs come up once.
EARLIER = 8


def shingles(h: np.ndarray, at: np.ndarray, n: int = N_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of documents' word hashes h with offsets at, and their own offsets."""
    count = np.diff(at)
    full = np.maximum(count - n + 1, 0)
    number = np.where(count >= n, full, (count > 0).astype(np.int64))
    out_at = np.concatenate([[0], np.cumsum(number)])
    out = np.empty(out_at[-1], np.uint64)
    if len(h) >= n:
        acc = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            acc += h[k : len(h) - n + 1 + k] * np.uint64((2 * k + 3) * 0xD6E8FEB86659FD93 % (1 << 64) | 1)
        acc = mix(acc)
        rows = np.repeat(np.arange(len(count)), full)
        place = np.arange(len(rows)) - np.repeat(np.cumsum(full) - full, full)
        out[out_at[rows] + place] = acc[at[rows] + place]
    for i in np.flatnonzero((count > 0) & (count < n)):
        v = np.full(1, count[i], np.uint64)
        for x in h[at[i] : at[i + 1]]:
            v = mix(v * np.uint64(0x9E3779B97F4A7C15) + x)
        out[out_at[i]] = v[0]
    return out, out_at


def document_sets(column, n: int):
    """Yields (row, sorted distinct shingle hashes) for a string column."""
    s, at = shingles(*words(column), n)
    for i in range(len(at) - 1):
        yield i, np.unique(s[at[i] : at[i + 1]])


def hashed_counts(docs: DataFrame, n: int) -> np.ndarray:
    """log2 of how often each slot's shingles occur in all documents: 2**COUNT_BITS bytes."""

    def update(total, batch):
        for p in pieces(batch, "text", 1 << 20):
            s, _ = shingles(*words(p.column("text")), n)
            np.add.at(total, (s >> np.uint64(64 - COUNT_BITS)).astype(np.int64), np.uint32(1))

    return np.log2(np.maximum(summed_table(docs.select("text"), 1 << COUNT_BITS, update, np.uint32), 1)).astype(np.uint8)


def signatures(docs: DataFrame, levels: np.ndarray, n: int, percent: int) -> DataFrame:
    """doc_id, size, two words that stand for the set, its bitmap and its rarest-first prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def sign(batches):
        level = shared.value
        for batch in batches:
            for p in pieces(batch, "text", 1 << 20):
                rows = p.num_rows
                size, bitmap = np.zeros(rows, np.int64), np.zeros((rows, BITMAP_WORDS), np.uint64)
                digest, prefix = np.zeros((rows, 2), np.uint64), [None] * rows
                for i, s in document_sets(p.column("text"), n):
                    m = size[i] = len(s)
                    if not m:
                        prefix[i] = np.zeros(0, np.int64)
                        continue
                    digest[i] = np.add.reduce(mix(s)), np.bitwise_xor.reduce(mix(s * np.uint64(3)))
                    bits = np.unique(s & np.uint64(64 * BITMAP_WORDS - 1))
                    np.bitwise_or.at(bitmap[i], (bits >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bits & np.uint64(63)))
                    k = m - (-(-percent * m // 100)) + 1
                    order = np.argsort(level[(s >> np.uint64(64 - COUNT_BITS)).astype(np.int64)], kind="stable")
                    prefix[i] = s[order[:k]].view(np.int64)
                lengths = np.concatenate([[0], np.cumsum([len(x) for x in prefix])])
                columns = [p.column("doc_id"), pa.array(size), *(pa.array(digest[:, j].view(np.int64)) for j in (0, 1)), *(pa.array(np.ascontiguousarray(bitmap[:, j]).view(np.int64)) for j in range(BITMAP_WORDS)), pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate(prefix) if rows else [], pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "d0", "d1", *(f"b{j}" for j in range(BITMAP_WORDS)), "prefix"])

    bitmaps = ", ".join(f"b{j} long" for j in range(BITMAP_WORDS))
    return docs.select("doc_id", "text").mapInArrow(lean(sign), f"doc_id long, n long, d0 long, d1 long, {bitmaps}, prefix array<long>")


def may_link(a: str, b: str, percent: int):
    """Whether sizes and bit counts allow the similarity: of t bits set on one side only, each stands
    for at least one member outside the intersection."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = sum((F.bit_count(F.col(f"{a}.b{j}").bitwiseXOR(F.col(f"{b}.b{j}"))) for j in range(BITMAP_WORDS)), F.lit(0))
    return (F.lit(100) * F.least(na, nb) >= F.lit(percent) * F.greatest(na, nb)) & (F.lit(100) * (na + nb - apart) >= F.lit(percent) * (na + nb + apart))


def wide_bitmap(s: np.ndarray) -> bytes:
    """A bitmap of at least eight bits a member; halves or-ed together give the narrower ones."""
    width = 1 << max(9, int(8 * max(len(s), 1) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(s % np.uint64(width)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def bits_allow(na: int, nb: int, x: bytes, y: bytes, percent: int) -> bool:
    u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(u) > len(v):
        u = u[: len(u) // 2] | u[len(u) // 2 :]
    while len(v) > len(u):
        v = v[: len(v) // 2] | v[len(v) // 2 :]
    apart = int(np.bitwise_count(u ^ v).sum(dtype=np.int64))
    return 100 * (na + nb - apart) >= percent * (na + nb + apart)


def verified(docs: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The (a, b) of pairs whose sets overlap enough: bitmaps as wide as the sets leave few pairs for
    the exact intersection of sorted arrays."""

    def sets(batches):
        for batch in batches:
            for p in pieces(batch, "text", 1 << 20):
                found = [s for _, s in document_sets(p.column("text"), n)]
                lengths = np.concatenate([[0], np.cumsum([len(x) for x in found])])
                arrays = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate(found).view(np.int64) if found else [], pa.int64()))
                yield pa.RecordBatch.from_arrays([p.column("doc_id"), pa.array([len(x) for x in found], pa.int64()), pa.array([wide_bitmap(x) for x in found], pa.binary()), arrays], ["doc_id", "n", "w", "s"])

    def near(batches):
        for batch in batches:
            c = batch.to_pydict()
            ok = [bits_allow(*x, percent) for x in zip(c["na"], c["nb"], c["wa"], c["wb"])]
            yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    def same(batches):
        for batch in batches:
            got = []
            x, y = batch.column("sa"), batch.column("sb")
            for i in range(batch.num_rows):
                u, v = x[i].values.to_numpy(), y[i].values.to_numpy()
                common = len(np.intersect1d(u, v, assume_unique=True))
                got.append(100 * common >= percent * (len(u) + len(v) - common))
            yield batch.filter(pa.array(got, pa.bool_())).select(["a", "b"])

    ids = written(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    texts = thinned(docs, ids).join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    arrays = written(texts.mapInArrow(lean(sets), "doc_id long, n long, w binary, s array<long>"))
    side = lambda k, *cols: arrays.select(F.col("doc_id").alias(k), *[F.col(c).alias(c + k) for c in cols])
    close = written(pairs.join(side("a", "n", "w"), "a").join(side("b", "n", "w"), "b").select("a", "b", "na", "nb", "wa", "wb").mapInArrow(lean(near), "a long, b long"))
    both = close.join(side("a", "s"), "a").join(side("b", "s"), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(lean(same), "a long, b long")


def tile_pairs(rows: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The pairs of keys_pairs, each once."""
    return keys_pairs(rows, facts, percent).distinct()


def keys_pairs(rows: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components within each key that sizes and bitmaps allow.
    rows: key, rep, comp; facts: rep, n, b0.. . Keys of more than TILE rows are cut into square tiles. A pair that shares
    one of the EARLIER keys before this one, in the order of both rows' keys, is left to that key: the first key that two
    rows share always returns them, so none is lost, and copies that share many keys come up about once."""
    bits, earlier = [f"b{j}" for j in range(BITMAP_WORDS)], [f"e{j}" for j in range(EARLIER)]
    groups = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
    own = rows.join(groups.where("lo <> hi").select("key", "blocks"), "key").groupBy("rep").agg(F.min("comp").alias("comp"), F.array_sort(F.collect_set(F.struct("key", "blocks"))).alias("ks"))
    rows = own.join(facts, "rep").select("rep", "comp", "n", *bits, "ks", F.posexplode("ks").alias("at", "k")).select("rep", "comp", "n", *bits, "at", "k.*", *[F.coalesce(F.get("ks", F.col("at") - j - 1)["key"], F.lit(0)).alias(e) for j, e in enumerate(earlier)])
    rows = rows.withColumn("i", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tile = rows.select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("tile"), F.when(F.col("i") <= F.col("j"), 0).otherwise(1).alias("side"), (F.col("i") == F.col("j")).alias("same"), "rep", "comp", "n", "at", *earlier, *bits)
    parts = tile.repartition("tile").sortWithinPartitions("tile", "n")

    def pairs_of(side, same, rep, comp, n, at, ea, bm):
        left = np.flatnonzero(side == 0)
        right = left if same[0] else np.flatnonzero(side == 1)
        # of an earlier key there may be fewer than EARLIER
        there = np.arange(EARLIER) < at[:, None]
        for k, x in enumerate(left):
            y = right[k + 1 :] if same[0] else right
            y = y[(100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])) & (comp[x] != comp[y]) & (rep[x] != rep[y])]
            if len(y):
                apart = np.bitwise_count(bm[y] ^ bm[x]).sum(axis=1, dtype=np.int64)
                y = y[100 * (n[x] + n[y] - apart) >= percent * (n[x] + n[y] + apart)]
                met = (ea[y][:, :, None] == ea[x][there[x]]) & there[y][:, :, None]
                y = y[~met.any(axis=(1, 2))]
                if len(y):
                    yield np.minimum(rep[x], rep[y]), np.maximum(rep[x], rep[y])

    def once(found):
        """The pairs of one task, each once: copies share many keys, so that their pair comes up in many tiles."""
        a, b = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return a[new], b[new]

    def run(batches):
        rest = None
        done = False
        found, size = [], 0
        it = iter(batches)
        while not done:
            batch = next(it, None)
            done = batch is None
            t = pa.Table.from_batches([x for x in (rest, batch) if x is not None]).combine_chunks() if (rest is not None or batch is not None) else None
            if t is None or not t.num_rows:
                continue
            keys = t.column("tile").to_numpy()
            cut = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
            rest = None
            if not done:
                rest = t.slice(cut[-2]).to_batches()[0]
                cut = cut[:-1]
            c = {k: t.column(k).to_numpy(zero_copy_only=False) for k in ("side", "same", "rep", "comp", "n", "at", *earlier, *bits)}
            ea = np.stack([c[k] for k in earlier], axis=1)
            bm = np.stack([c[k].view(np.uint64) for k in bits], axis=1)
            for lo, hi in zip(cut[:-1], cut[1:]):
                if hi - lo > 1:
                    more = list(pairs_of(*(c[k][lo:hi] for k in ("side", "same", "rep", "comp", "n", "at")), ea[lo:hi], bm[lo:hi]))
                    if more:
                        # one array a tile, as small ones take more memory than their pairs
                        found.append(tuple(np.concatenate(x) for x in zip(*more)))
                        size += len(found[-1][0])
                    if size > HELD_PAIRS:
                        a, b = once(found)
                        found, size = [(a, b)], len(a)
                        if size > HELD_PAIRS // 2:
                            yield pa.RecordBatch.from_pydict({"a": a, "b": b})
                            found, size = [], 0
        if found:
            a, b = once(found)
            yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    return parts.mapInArrow(lean(run), "a long, b long")


def with_rows(docs: DataFrame) -> DataFrame:
    """docs with __row, a number for each pair of id and text: the id itself wherever it stands for one text, so that the
    first document of a group leads its copies; a hash of both for null ids and for ids of several texts. Which ids those
    are goes to the tasks up to ODD_IDS; beyond, every row has the hash."""
    id_, text = F.col("doc_id").cast("long"), F.xxhash64("text")
    mixed = F.xxhash64(F.struct(id_.isNull(), id_, F.col("text")))
    several = docs.where("doc_id is not null").select(id_.alias("__id"), text.alias("t")).groupBy("__id").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).where("lo <> hi")
    several = written(several.select("__id"))
    n = several.count()
    if n > ODD_IDS:
        return docs.withColumn("__row", mixed)
    odd = F.lit(False)
    if n:
        docs = docs.join(F.broadcast(several.withColumn("__odd", F.lit(True))), id_ == F.col("__id"), "left").drop("__id")
        odd = F.coalesce("__odd", F.lit(False))
    return docs.withColumn("__row", F.when(id_.isNull() | odd, mixed).otherwise(id_)).drop("__odd")


def jaccard_components(docs: DataFrame, n: int = N_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text).

    Rows that repeat an id with another text are documents of their own; the component is the smallest id that any row of
    it has (null where none has one). Rows without a shingle have their own id."""
    keyed = with_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    comp = key_components(keyed.select(F.col("__row").alias("doc_id"), "text"), n, percent).distinct()
    rows = written(keyed.select(F.col("doc_id").alias("id"), F.col("__row").alias("doc_id")).join(comp, "doc_id"))
    # written, so that a component with very many rows is cut in this join
    least = written(rows.groupBy("component_id").agg(F.min("id").alias("least")))
    return rows.join(least, "component_id").select(F.col("id").alias("doc_id"), "n_shingles", F.col("least").alias("component_id"))


def key_components(docs: DataFrame, n: int = N_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of docs (doc_id long, text string), whose ids are not null and each stand for
    one text."""
    sig = written(signatures(docs, hashed_counts(docs, n), n, percent))
    sets = sig.where("n > 0").select("doc_id", "n", "d0", "d1")
    classes = sets.groupBy("d0", "d1", "n").agg(F.min("doc_id").alias("rep"))
    member = written(sets.join(classes, ["d0", "d1", "n"]).select("doc_id", "rep").distinct())
    keys = sig.select("doc_id", F.explode("prefix").alias("key"))
    leads = keys.groupBy("key").agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("last")).where("lead <> last").drop("last")
    hits = written(keys.join(leads, "key"))
    facts = sig.drop("prefix", "d0", "d1").dropDuplicates(["doc_id"])

    best = hits.where("doc_id <> lead").groupBy("doc_id", "lead").count().groupBy("doc_id").agg(F.max_by("lead", F.struct("count", F.negative("lead"))).alias("lead"))
    first = best.join(member, "doc_id").select(F.col("rep").alias("b"), F.col("lead").alias("doc_id")).join(member, "doc_id").select(F.col("rep").alias("a"), "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    allowed = first.join(facts.alias("x"), F.col("a") == F.col("x.doc_id")).join(facts.alias("y"), F.col("b") == F.col("y.doc_id")).where(may_link("x", "y", percent)).select("a", "b")
    edges = written(verified(docs, written(allowed), n, percent))
    comp = written(components(edges))

    # equal sets have equal keys: the rows of those that stand for them are enough
    in_comp = member.where("doc_id = rep").join(comp, member["rep"] == comp["node"], "left").select("doc_id", F.coalesce("component", "rep").alias("comp"))
    placed = written(hits.select("key", "doc_id").join(in_comp, "doc_id").select("key", F.col("doc_id").alias("rep"), "comp"))
    second = written(tile_pairs(placed, facts.withColumnRenamed("doc_id", "rep"), percent))
    more = verified(docs, second, n, percent)
    final = components(edges.union(more))

    out = sig.select("doc_id", F.col("n").alias("n_shingles")).join(member.dropDuplicates(["doc_id"]), "doc_id", "left")
    return out.join(final, out["rep"] == final["node"], "left").select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, n: int = N_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of docs for each component: that of the smallest doc_id, rows without an id last. Rows are
    told apart by doc_id and text, so that a null or repeated id is no hindrance; of equal ones, copies
    of each other, one stays. All rows without a shingle stay."""
    keyed = with_rows(docs)
    comp = key_components(keyed.select(F.col("__row").alias("doc_id"), "text"), n, percent).withColumnRenamed("doc_id", "__row").distinct()
    facts = keyed.select("__row", F.col("doc_id").cast("long").alias("id")).groupBy("__row").agg(F.min("id").alias("id"), F.count("*").alias("times"))
    facts = written(facts.join(comp, "__row"))
    first = facts.where("n_shingles > 0").groupBy("component_id").agg(F.min_by(F.struct("__row", "times"), F.struct(F.col("id").isNull(), "id", "__row")).alias("r"))
    keep = first.select("r.__row", (F.col("r.times") > 1).alias("__several")).union(facts.where("n_shingles = 0").select("__row", F.lit(False)))
    kept = keyed.join(written(keep), "__row")
    return kept.where("not __several").union(kept.where("__several").dropDuplicates(["__row"])).select(docs.columns)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


QUERIES = {"op8_ngram_jaccard_join": op8_ngram_jaccard_join}

SQL = {
    "op8_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS t FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM e x JOIN e y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY 1, 2),
k AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS node, doc_id AS seen FROM n UNION SELECT r.node, k.b FROM r JOIN k ON r.seen = k.a)
SELECT n.doc_id, n.n AS n_shingles, (SELECT min(seen) FROM r WHERE r.node = n.doc_id) AS component_id FROM n
""",
}
