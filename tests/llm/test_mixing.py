import random
from collections import defaultdict

import pytest

from wordflow.llm.mixing import MOST_COPIES, cuts, mix_sources, source_targets


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in order if s not in stopped]
        rest = total - sum(3 * sizes[s] for s in stopped)
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return {**{s: 3 * sizes[s] for s in stopped}, **share}
        stopped |= over


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": int(10 ** rng.uniform(0, 6)) for i in range(11)} | {None: 400, "Ä": 7, "": 30}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in source_targets(frame).collect()}
    assert got == pytest.approx(brute_targets(sizes))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def corpus(spark, n=2000, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", "small", None])
        words = int(rng.paretovariate(1.1) * 3) if source != "small" or i % 50 == 0 else 0
        rows.append((i, " ".join(["w"] * min(words, 4000)), source))
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_every_source_comes_near_its_target(spark):
    docs = corpus(spark)
    rows = mix_sources(docs, carry=docs.select("doc_id", "source")).collect()
    assert sorted(r.doc_id for r in rows) == list(range(2000))
    by = defaultdict(list)
    for r in rows:
        assert r.taken % max(1, r.size) == 0 and 0 <= r.taken <= MOST_COPIES * r.size
        by[r.source].append(r)
    wanted = brute_targets({s: sum(r.size for r in found) for s, found in by.items()})
    for source, found in by.items():
        assert {r.source_size for r in found} == {sum(r.size for r in found)}
        assert {r.target for r in found} == {found[0].target}
        assert found[0].target == pytest.approx(wanted[source])
        assert abs(sum(r.taken for r in found) - found[0].target) <= max(r.size for r in found) / 2 + 1e-6


def test_longer_documents_are_likelier_and_reruns_agree(spark):
    docs = corpus(spark)
    carried = docs.select("doc_id", "source")
    first, again = (sorted(map(tuple, mix_sources(docs.repartition(n), carry=None).drop("text").collect())) for n in (3, 7))
    assert first == again
    other = sorted(map(tuple, mix_sources(docs, carry=carried, seed="other").collect()))
    assert other != first
    hot = [r for r in mix_sources(docs, carry=carried).collect() if r.source == "hot" and r.size]
    short = [r.taken / r.size for r in hot if r.size < 4]
    long = [r.taken / r.size for r in hot if r.size > 30]
    assert sum(short) / len(short) < sum(long) / len(long)


def test_cut_is_that_of_the_sorted_order(spark):
    rng = random.Random(2)
    rows, wanted = [], {}
    for source in ("x", None, "ties", "all"):
        own = []
        for i in range(400):
            rank = 7 if source == "ties" else rng.getrandbits(53)
            own.append((source, rank, (i % 3 << 33) + i, rng.randint(1, 50)))
        own.sort(key=lambda r: r[1:3])
        left = float(10**9) if source == "all" else sum(r[3] for r in own) * 0.37
        passed = 0
        for r in own:
            if passed + r[3] > left:
                wanted[source] = (r[1], r[2], 2 * (left - passed) >= r[3])
                break
            passed += r[3]
        rows += [(*r, left) for r in own]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "source string, rank bigint, number bigint, size bigint, left double")
    assert {r.source: (r["rank"], r.number, r.last) for r in cuts(frame).collect()} == wanted


def test_nulls_repeats_and_clashing_names(spark, docs, no_docs):
    rows = mix_sources(docs.withColumn("size", docs["n_chars"]).withColumn("rank", docs["n_chars"]))
    assert rows.columns[-4:] == ["size", "source_size", "target", "taken"]
    got = rows.collect()
    assert len(got) == docs.count()
    assert all(r.taken == 0 for r in got if r.doc_id in (4, 5, 6))
    assert {r.fp for r in got} == {"own fp"}
    repeated = [r.taken for r in got if r.doc_id == 9]
    assert len(repeated) == 2 and all(t % 2 == 0 and t <= 6 for t in repeated)
    assert mix_sources(no_docs).count() == 0


def test_only_dataframe_functions(spark):
    docs = corpus(spark, 50)
    plan = mix_sources(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
