"""Problem 1 where the n of the n-grams changes, and counts without pairs; problem 8 on many weights."""

import random
from collections import Counter

from annolytics.llm import mix, overlap
from annolytics.llm.defects import judge, tokens

QA = "record_uuid string, split string, query string, answer string"


def match(a, b):
    x, y = Counter(tokens(a)), Counter(tokens(b))
    n = max(sum(x.values()), sum(y.values()))
    return 5 * sum((x & y).values()) >= 4 * n


def edge_rows(seed):
    """Queries of sizes around the two limits, each with copies that differ in just as many words as allowed, or one more."""
    rnd = random.Random(seed)
    words = [f"w{chr(97 + i)}{chr(97 + j)}{chr(97 + k)}" for i in range(9) for j in range(9) for k in range(9)]
    rows = []
    for n in (1, 2, 3, 4, 5, 159, 160, 161, 199, 200, 201, 202, 249, 250, 251, 252):
        q = rnd.sample(words, n)
        rows.append((f"t{n}", "train", " ".join(q), "Das gilt so für alle Orte."))
        for extra in (0, 1, -1, n // 4, -(n // 5)):
            for changed in {0, n // 5, n // 5 + 1}:
                p = q[: n + extra] if extra < 0 else q + rnd.sample(words, extra)
                for i in rnd.sample(range(len(p)), min(changed, len(p))):
                    p[i] = f"x{i}"
                rnd.shuffle(p)
                if p:
                    rows.append((f"e{n}_{extra}_{changed}", "test", " ".join(p), "Das gilt so für alle Orte."))
    return rows


def test_no_pair_is_lost_where_n_changes(spark):
    rows = edge_rows(1)
    ok = [r for r in rows if not judge(r[2], r[3])[0]]
    want = {(a[0], b[0]) for a in ok for b in ok if a[1] == "train" != b[1] and match(a[2], b[2])}
    got = {(r.train_uuid, r.eval_uuid) for r in overlap.overlaps(spark.createDataFrame(rows, QA)).collect()}
    assert got == want and len(want) > 40


def test_counts_are_those_of_the_pairs(spark):
    rnd = random.Random(2)
    rows = [r for r in edge_rows(3) if len(r[2]) < 60]
    # many copies, records that were delivered again with another text, and one with two splits
    rows += [(f"c{i}", rnd.choice(["train", "test"]), "wie viele orte sind es", "Es sind vier Orte.") for i in range(30)]
    rows += [(f"c{i}", "train" if i % 2 else "test", "wie viele orte sind es nun", "Es sind vier Orte!") for i in range(0, 30, 3)]
    df = spark.createDataFrame(rows, QA)
    want = Counter(r.eval_uuid for r in overlap.overlaps(df).collect())
    got = {r.eval_uuid: r.n_pairs for r in overlap.overlap_counts(df).collect()}
    assert got == dict(want) and max(got.values()) > 10
    assert overlap.overlap_counts(df.limit(0)).count() == 0


def test_a_thousand_weights_have_all_their_slots():
    rnd = random.Random(9)
    for _ in range(1000):
        quota = {f"s{i}": rnd.choice([0, 1, rnd.randint(1, 50), rnd.randint(1, 5000)]) for i in range(rnd.randint(1, 10))}
        block = max(1, -(-sum(quota.values()) // 300))
        need = {s: -(-q // block) for s, q in quota.items()}
        slots = mix.schedule(quota, sum(need.values()), need)
        assert [s for s, _, _ in slots] == list(range(sum(need.values())))
        assert Counter(s for _, s, _ in slots) == Counter({s: n for s, n in need.items() if n})


def test_shares_or_use(spark):
    docs = spark.createDataFrame([(i, "small" if i < 2 else "large", 10) for i in range(100)], "doc_id long, source string, n_tokens int")
    targets = spark.createDataFrame([("small", 0.5, 1), ("large", 0.5, 1)], "source string, target_share double, max_repeats int")
    kept = {r.source: r.actual_share for r in mix.mixed(docs, targets, least_use=0.0)[1].collect()}
    used = {r.source: r.mixed_tokens for r in mix.mixed(docs, targets, least_use=0.25)[1].collect()}
    assert kept == {"small": 0.5, "large": 0.5} and used["small"] == 20 and used["large"] > 20
