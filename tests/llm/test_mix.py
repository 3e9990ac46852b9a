"""The mix itself, copies and positions, against brute force and SQL."""

import hashlib
import math
import random

from wattlake.llm import mixing


def test_the_mix_has_every_copy_at_its_position(spark, sf, duck):
    rng = random.Random(7)
    docs = [(i, "w " * rng.randrange(0, 30), f"s{min(rng.randrange(6), 3)}") for i in range(300)]
    got = [(r.doc_id, r.position) for r in mixing.mixed(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()]
    size = {i: len(t.split()) for i, t, _ in docs}
    sources = sorted({s for _, _, s in docs})
    own = {s: sum(size[i] for i, _, x in docs if x == s) for s in sources}
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(sources)}
    target, left, free = {}, mixing.BUDGET * sum(own.values()), set(sources)
    while free:  # fill the sources that reach their cap, share the rest by weight
        full = {s for s in free if left / sum(weight[x] for x in free) * weight[s] > mixing.CAP * own[s]}
        if not full:
            level = left / sum(weight[x] for x in free)
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: mixing.CAP * own[s] for s in full}
        left, free = left - sum(target[s] for s in full), free - full
    want = []
    for k, s in enumerate(sources):
        r, start = mixing.RAMPS[k % 3], 0
        rounds = math.floor(target[s] / own[s])
        for i in sorted((i for i, _, x in docs if x == s), key=lambda i: hashlib.md5(str(i).encode()).hexdigest()):
            copies = rounds + (start + size[i] / 2 < target[s] - rounds * own[s]) if size[i] else 0
            for c in range(copies):
                # the share taken up to time t is (1 - r) t + r t^2; bisect for the copy's
                lo, hi, u = 0.0, 1.0, (start + c * own[s]) / target[s]
                for _ in range(60):
                    mid = (lo + hi) / 2
                    lo, hi = (mid, hi) if (1 - r) * mid + r * mid * mid < u else (lo, mid)
                want.append((i, lo))
            start += size[i]
    assert [round(p, 6) for _, p in got] == sorted(round(p, 6) for _, p in got)
    got, want = sorted(got), sorted(want)
    assert [i for i, _ in got] == [i for i, _ in want] and all(abs(a - b) < 1e-6 for (_, a), (_, b) in zip(got, want))
    assert "op9_curriculum_order" in mixing.QUERIES
    for name, query in mixing.QUERIES.items():
        rows = lambda found: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in found), key=str)
        assert rows(map(tuple, query(spark, sf).collect())) == rows(duck.execute(mixing.SQL[name]).fetchall())


def test_texts_are_shuffled_once_before_they_are_dealt(spark):
    """The sums inside buckets and the join with the buckets' offsets share one exchange of the texts."""
    docs = spark.range(50).selectExpr("id as doc_id", "if(id % 7 = 0, null, concat('s', id % 3)) as source", "repeat('w ', cast(id % 9 as int)) as text")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = mixing.placed(docs)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        # the texts, sums by bucket, and two sides of the joins with targets and with offsets
        shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x]
        assert not [x for x in shuffles if "coalesce(source" in x and "__b" in x]
        assert sum("hashpartitioning(__k1" in x for x in shuffles) == 2
        assert {r.source for r in rows.collect()} == {None, "s0", "s1", "s2"} and rows.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
