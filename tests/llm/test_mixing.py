from collections import Counter, defaultdict

import pytest

from slabwise.llm.mixing import mix, mixed_documents, source_targets


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, epochs=2):
    """Clamp and deal again until nothing is above its cap."""
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    target, free = dict.fromkeys(sizes, 0.0), set(sizes)
    left = share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level >= epochs * sizes[s]}
        for s in over or free:
            target[s] = float(epochs * sizes[s]) if over else weight[s] * level
        if not over:
            break
        left -= sum(target[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 20, None: 5}, {"x": 7}, {"a": 0, "b": 0}, {chr(97 + i): (i * 37) % 101 for i in range(20)}, {"a": 1, "B": 1, "é": 1, "z": 1, None: 1}])
def test_targets_equal_repeated_clamping(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def documents(n=300):
    return [(i, " ".join(["w"] * (i * 7 % 53)), "en", None if i % 11 == 0 else f"s{i % 4 if i % 3 else 0}") for i in range(n)]


def test_taken_words_reach_the_targets(frame):
    rows = [*documents(), (1000, None, None, "s1"), (1001, "", None, "s1"), (None, "no id here", None, "s2"), (None, "no id here", None, "s2"), (5, "same id twice", None, "s3")]
    got = mix(frame(rows)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len((text or "").split())
    targets, taken = brute_targets(sizes), defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)


def test_reruns_and_seeds(frame):
    rows = documents(120)
    a, b, c = (sorted((r.doc_id, r.taken) for r in mix(frame(rows), seed=s).collect()) for s in ("mix", "mix", "other"))
    assert a == b and a != c


def test_mixed_documents_repeat_whole_rows(frame):
    df = frame(documents(80))
    rows, counted = mixed_documents(df), {r.doc_id: r for r in mix(df).collect()}
    assert rows.columns == df.columns
    times = Counter(r.doc_id for r in rows.collect())
    assert all(times[i] == (int(r.taken / r.size + 0.5) if r.size else 0) for i, r in counted.items())
    assert {r.size for r in rows.collect()} == {7}


def test_empty_table(frame):
    assert mix(frame([])).collect() == [] and mixed_documents(frame([])).collect() == []
