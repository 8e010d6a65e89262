"""The kernel against its definition, the classifier by held-out accuracy, defined results."""

import zlib
from itertools import combinations

import numpy as np

from threadmill.llm import toxicity as T
from tests.llm.cases import documents, odd_documents


def brute_kernel(s, t, p, decay):
    total = 0.0
    for a in combinations(range(len(s)), p):
        for b in combinations(range(len(t)), p):
            if all(s[i] == t[j] for i, j in zip(a, b)):
                total += decay ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_kernel_against_its_definition():
    words = ["idiot", "idot", "xidiotx", "i-d-i-o-t", "aaaa", "ab", "", "löser", "tidio"]
    pairs = [(a, b) for a in words for b in words]
    for p in (1, 2, 3, 4):
        got = T.subsequence_kernel(T._codes([a for a, _ in pairs], 10), T._codes([b for _, b in pairs], 9), p, 0.7)
        for (a, b), g in zip(pairs, got):
            assert abs(g - brute_kernel(a, b, p, 0.7)) < 1e-4 * (1 + g), (a, b, p)


def test_features_tolerate_gaps_and_insertions():
    k = T.Kernel(["idiot", "worthless"], T.Settings(least_kernel=0.2))
    values = k.features(["idiot", "idixot", "i.d.iot", "worthlesss", "worrthless", "garden", "", "idiot" * 9])
    assert values[0][0] > 0.999 and values[5] is None and values[6] is None
    assert all(values[i][0] > 0.35 for i in (1, 2)) and all(values[i][1] > 0.6 for i in (3, 4)) and values[7][0] > 0.2


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in T.op7(spark, "/root/testdata/sf0.1").collect()}
    labels = [r for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect() if rows[r.doc_id].held_out]
    assert len(rows) == 10000 and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    y = np.array([r.toxic for r in labels])
    s = np.array([rows[r.doc_id].score for r in labels])
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert auc > 0.88 and ((s >= 0.5) == y).mean() > 0.92  # labels of the languages but English are partly noise here
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())


def test_defined_results(spark):
    odd = odd_documents(spark)
    labels = spark.createDataFrame([(4, 1), (9, 0), (10, 0), (8, 0), (77, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    model = T.fit(odd, labels)
    out = T.score(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    assert T.fit(odd, labels.where("toxic = 0")) is None and T.fit(documents(spark, []), labels) is None
    assert {r.score for r in T.score(odd, None).collect()} == {0.0}
    assert T.score(documents(spark, []), model).count() == 0


def test_scores_read_the_whole_text():
    clean = [f"the garden of words number {i} is calm. and green" for i in range(60)]
    toxic = [f"the garden of words number {i}. you moron are here" for i in range(60)]
    model = T.fit_texts(clean + toxic, np.array([0] * 60 + [1] * 60))
    score = T.Scorer(model).scores(["calm words. " * 30000 + "moron", "calm words. " * 30000, "m-o-ron", ""])
    assert score[0] > 0.5 > score[1] and score[2] > score[3] and score[3] < 0.5


def test_repetition_counts():
    rng = np.random.default_rng(7)
    calm = ["garden", "words", "number", "calm", "green", "house", "river", "stone"]

    def text(hits, n=120):
        words = list(rng.choice(calm, n))
        for i in rng.choice(n, hits, replace=False):
            words[i] = "achlich"
        return " ".join(words)

    # half of the clean texts hold the word once, by chance
    draw = lambda n: [text(int(rng.integers(0, 2))) for _ in range(4 * n)] + [text(int(rng.integers(4, 20))) for _ in range(n)]
    y = np.array([0] * 240 + [1] * 60)
    model = T.fit_texts(draw(60), y, T.Settings(lift=1.5))
    found = np.array(T.Scorer(model).scores(draw(60))) >= 0.5
    assert found[y == 1].mean() > 0.95 and found[y == 0].mean() < 0.02


def test_recall_in_each_language(spark):
    rows = {r.doc_id: r.predicted for r in T.op7(spark, "/root/testdata/sf0.1").where("held_out").collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang").collect()}
    count = {}
    for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect():
        if r.doc_id in rows:
            some = count.setdefault((lang[r.doc_id], r.toxic), [0, 0])
            some[0] += rows[r.doc_id]
            some[1] += 1
    for code in ("en", "de", "fr"):
        assert count[code, 1][0] > 0.6 * count[code, 1][1], count
    for code in ("en", "de", "fr", "es"):
        assert count[code, 0][0] < 0.03 * count[code, 0][1], count


def test_blanks_within_a_word():
    clean = [f"the garden of words number {i}. you are here calm and green" for i in range(60)]
    toxic = [f"the garden of words number {i}. you {'moron' if i % 2 else 'worthless'} are here" for i in range(60)]
    scorer = T.Scorer(T.fit_texts(clean + toxic, np.array([0] * 60 + [1] * 60)))
    score = lambda t: scorer.scores([t])[0]
    assert score("you are so it is to be on a hot day") == score("") < 0.5 < score("you moron")
    for plain, gapped in [
        ("moron", "m o r o n"), ("moron", "mo ron"), ("moron", "m - o - r - o - n"), ("you are a moron.", "you are a m o r o n."),
        ("you are moron so", "you are m o\nr\to n so"), ("worthless", "wo rth le ss"),
    ]:
        assert score(gapped) > 0.5 and abs(score(gapped) - score(plain)) < 0.05, gapped
    assert score("m o r x o n") > score("") and score("idle m o r o n " + "calm words. " * 3000) > 0.5


def test_every_family_has_a_landmark():
    rng = np.random.default_rng(3)
    families = ["".join(rng.choice(list("bcdfghklmnprstvwxz"), 7)) for _ in range(40)]
    clean = [f"the garden of words number {i}. it is calm and green" for i in range(1200)]
    toxic = [f"the garden of words number {i}. it is {families[i % 40]} and green" for i in range(1200)]
    model = T.fit_texts(clean + toxic, np.array([0] * 1200 + [1] * 1200))
    found = T.Kernel(model["landmarks"], T.Settings()).features(families)
    assert all(f is not None and f.max() >= T.Settings().apart for f in found)
    scores = T.Scorer(model).scores([f"it is {w} and green" for w in families] + ["it is calm and green"])
    assert min(scores[:-1]) > 0.5 > scores[-1]


def test_training_reads_whole_texts(spark):
    rows = [(i, "calm green words. " * 1500 + ("moron here." if i % 2 else "garden here.")) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    model = T.fit(documents(spark, rows), labels)
    assert any(w in "moron" for w in model["landmarks"])
    score = T.Scorer(model).scores([rows[1][1], rows[2][1]])
    assert score[0] > 0.5 > score[1]


def test_near_copies_count_once():
    rng = np.random.default_rng(3)
    plain = ["".join(rng.choice(list("abcdefghiklmnoprstu"), 7)) for _ in range(400)]
    text = lambda: list(rng.choice(plain, 60))
    clean = [" ".join(text()) for _ in range(80)]
    copied = text() + ["moron", "quixotry"]
    copies = []
    for i in range(40):  # each differs by a word
        words = list(copied)
        words[i] = "other"
        copies.append(" ".join(words))
    toxic = copies + [" ".join(text() + ["moron"]) for _ in range(40)]
    model = T.fit_texts(clean + toxic, np.array([0] * 80 + [1] * 80))
    assert "moron" in model["landmarks"]
    assert not any(w.startswith("quix") for w in model["landmarks"])
    assert T.sketch([]) == T.sketch([]) and T.sketch(copied) >= 0


def _random_words(n, seed=5):
    rng = np.random.default_rng(seed)
    marks = ["idiot", "worthless", "loser", "lowei", "lowest", "disgusting", "banana"]
    words = []
    for _ in range(n):
        w = list(rng.choice(marks)) if rng.random() < 0.5 else list(rng.choice(list("lowestidrugnabh"), rng.integers(1, 30)))
        for _ in range(rng.integers(0, 4)):
            w.insert(rng.integers(0, len(w) + 1), rng.choice(list("xyloweés\0-")))
        words.append("".join(w))
    return marks, words


def test_pairs_left_out_have_small_kernels():
    marks, words = _random_words(3000)
    settings = T.Settings()
    k = T.Kernel(marks, settings)
    found = k.features(words)
    least = np.maximum(2, np.ceil(np.bitwise_count(k.masks) * settings.common))
    for word, got in zip(words, found):
        want = np.zeros(len(marks), np.float32)
        marked = T.START + word
        for j in range(0, max(1, len(marked) - 10), 10):
            codes = T._codes([marked[j : j + 20]] * len(marks), 20)
            on = np.bitwise_count(k._masks(codes) & k.masks) >= least
            own = k._self(codes)
            value = np.where(on, T.subsequence_kernel(k.codes, codes, settings.order, settings.decay) / (own * k.own), 0)
            want = np.maximum(want, np.where(value >= settings.least_kernel, value, 0))
        assert np.allclose(want, 0 if got is None else got, atol=1e-5), word
    reached = k.features(words, some_reach=0.6)
    for a, b in zip(found, reached):
        assert (b is None or (a == b).all()) and (b is not None or a is None or a.max() < 0.6)


def test_kernels_are_worked_out_where_they_can_be_large(monkeypatch):
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("lowestidrugnabh"), rng.integers(8, 15))) for _ in range(3000)]
    k = T.Kernel(_random_words(0)[0], T.Settings())
    worked, plain = [], T.subsequence_kernel
    monkeypatch.setattr(T, "subsequence_kernel", lambda a, b, order, decay: worked.append(len(b)) or plain(a, b, order, decay))
    k.features(words)
    assert sum(worked) < 4000  # 2530 pairs, of words with landmarks and with themselves; 5611 when order and letters alone decided


def test_core_of_a_word():
    for word, want in {"idiot!!": "idiot", "(é)": "é", "": "", "...": "", "a-b,": "a-b", "«don't»": "don't", "–x–y–": "x–y", "_a_": "a", "²!": "²"}.items():
        assert T.core(word) == want


def test_scores_do_not_hang_on_what_a_worker_remembers(monkeypatch):
    model = T.fit_texts(["you are a moron today", "what a moron here", "moron it is"] * 3 + ["a calm day of it", "it is so in my town"] * 6, np.array([1] * 9 + [0] * 12))
    texts = ["a mo ron of it. so my m o r o n", "", "calm", "the m.o.r.o.n is in a to do", "it is a b c d moron"] * 3
    whole = T.Scorer(model).scores(texts)
    monkeypatch.setattr(T, "WORDS", 2)
    monkeypatch.setattr(T, "RUNS", 1)
    few = T.Scorer(model)
    assert whole == [few.scores([t])[0] for t in texts] and whole[0] != whole[1]
