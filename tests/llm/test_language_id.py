import random
import zlib

import numpy as np

from slabwise.llm import language_id as module
from slabwise.llm.language_id import fit, identify, identify_rows, normalised_presence, presence

SYLLABLES = {"en": "the th ing ed and er on at".split(), "de": "der sch ung ein und ß ch ü".split(), "fr": "le eau tion é qu ou ç eux".split()}


def texts(n, seed):
    rng = random.Random(seed)
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        yield i, " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(10, 60))), lang


def test_held_out_accuracy_and_reruns(frame):
    rows = [*texts(400, 1)]
    df = frame([(i, t, lang, "s") for i, t, lang in rows])
    got = {r.doc_id: r for r in identify(df).collect()}
    truth = {i: lang for i, _, lang in rows}
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held_out} == set(out)
    assert np.mean([got[i].lang_pred == truth[i] for i in out]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    assert sorted(identify(df).collect()) == sorted(got.values())


def test_predictions_see_the_text_alone(frame):
    rows = [(i, t, lang, "s") for i, t, lang in texts(200, 2)]
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    swapped = [r if r not in held else (r[0], r[1], "xx", "other") for r in rows]
    a, b = ({r.doc_id: r for r in identify(frame(x)).collect()} for x in (rows, swapped))
    assert a == b and "xx" not in {r.lang_pred for r in b.values()}


def test_odd_rows(frame, messy):
    rows = [(i, t, lang, "s") for i, t, lang in texts(100, 3)]
    odd = [(i if i is None else i + 1000, t) for i, t in messy] + [(2000, "12 34 :-) 漢"), (2001, "12 34 :-)")]
    got = identify(frame(rows + odd)).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in got}
    for i in (1005, 1006, 1007, 2001):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[2000].lang_pred != "und"
    assert {r.lang_pred for r in got} <= {*SYLLABLES, "und"}


def test_nothing_labelled_and_nothing_at_all(frame):
    assert {r.lang_pred for r in identify(frame([(1, "some words"), (2, None)])).collect()} == {"und"}
    assert identify(frame([])).collect() == []


def test_rows_keep_their_columns(frame):
    df = frame([(i, t, lang, "s") for i, t, lang in texts(30, 4)])
    got = identify_rows(df)
    assert got.columns == [*df.columns, "lang_pred", "score"] and {r.key for r in got.collect()} == {7}


def test_sample_is_bounded_and_whole_texts_are_scored(frame, monkeypatch):
    df = frame([(i, t, lang, "s") for i, t, lang in texts(300, 5)])
    picked = module.sample(df, per_language=20)
    assert max(np.unique([lang for lang, _ in picked], return_counts=True)[1]) <= 20 and len(picked) > 45
    long = "the and thing " * 5 + "sch ung ein und der ß ü " * 4000
    rows = [(i, t, lang, "s") for i, t, lang in texts(200, 6)] + [(5000, long)]
    assert {r.doc_id: r.lang_pred for r in identify(frame(rows)).collect()}[5000] == "de"


def test_kernel_is_shared_presence():
    a, b = presence(["ab ab", "ab"])
    assert b.sum() <= a.sum() and (a * b).sum() == b.sum()
    unit = normalised_presence(["some text", "some text"])
    assert np.allclose(unit @ unit.T, 1)
    assert (presence(["ab"]) != presence(["ba"])).any()


def test_fit_separates_its_classes():
    rows = [(t, lang) for _, t, lang in texts(120, 7)]
    model = fit([t for t, _ in rows], [lang for _, lang in rows], landmarks_per_language=10)
    best = model.scores([t for t, _ in rows]).argmax(axis=1)
    assert np.mean([model.languages[k] == lang for k, (_, lang) in zip(best, rows, strict=True)]) > 0.98


def test_scores_equal_a_plain_solution():
    """The same regression with explicit kernels: Nystroem features by a Cholesky factor."""
    rows = [(t, lang) for _, t, lang in texts(90, 8)]
    names = sorted({lang for _, lang in rows})
    model = fit([t for t, _ in rows], [lang for _, lang in rows], landmarks_per_language=6)

    def grams(text):
        row = presence([text])[0]
        return {int(i) for i in np.flatnonzero(row)}

    def kernel(a, b):
        return len(a & b) / np.sqrt(max(len(a), 1) * max(len(b), 1))

    sets = [grams(t) for t, _ in rows]
    marks = [s for name in names for s in [s for s, (_, lang) in zip(sets, rows, strict=True) if lang == name][:6]]
    factor = np.linalg.cholesky(np.array([[kernel(a, b) for b in marks] for a in marks]))
    features = np.array([np.append(np.linalg.solve(factor, [kernel(s, m) for m in marks]), 1) for s in sets])
    counts = {n: sum(lang == n for _, lang in rows) for n in names}
    weight = np.array([1 / counts[lang] for _, lang in rows])
    targets = np.array([[1.0 if lang == n else -1.0 for n in names] for _, lang in rows])
    solved = np.linalg.solve(features.T @ (weight[:, None] * features) + module.RIDGE * np.eye(features.shape[1]), features.T @ (weight[:, None] * targets))
    new = [t for _, t, _ in texts(20, 9)]
    want = np.array([np.append(np.linalg.solve(factor, [kernel(grams(t), m) for m in marks]), 1) for t in new]) @ solved
    assert np.allclose(model.scores(new), want, atol=1e-3)


def test_languages_of_copies_and_rare_ones_are_learned(frame):
    rows = [(i, t, lang, "s") for i, t, lang in texts(300, 10)]
    copies = [(1000 + i, "zuw xoq wuq zox quz " * 9, "xx", "s") for i in range(1500)]
    rare = [(5000 + i, f"k{'ö' * (i + 1)} kwö pwö twö " * 5, f"l{i}", "s") for i in range(250)]
    picked = module.sample(frame(rows + copies + rare, clash=False))
    assert {lang for lang, _ in picked} == {*SYLLABLES, "xx", *(f"l{i}" for i in range(250))}
    got = {r.doc_id: r.lang_pred for r in identify(frame(rows + copies)).collect()}
    assert {got[1000 + i] for i in range(1500)} == {"xx"}


def test_spans_come_from_the_whole_text(frame):
    long = [(i, f"{'a' * 30_000} {i} {'b' * 30_000}", "x", "s") for i in range(60)]
    spans = [t for _, t in module.sample(frame(long, clash=False))]
    assert all(len(t) == module.SPAN_CHARS for t in spans)
    assert any("a" in t for t in spans) and any("b" in t for t in spans)
