"""Language ID, lattice likelihood and quality classifier."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from basketloom.llm import langid, lattice_lm, mil_quality


def rest(i, n):
    return zlib.crc32(str(i).encode()) % n


WORDS = {"de": "der und nicht schön mit haus wasser über ein strasse", "fr": "le et pas été avec maison eau où un rue",
         "en": "the and not nice with house water over a street"}


def language_rows(n=240):
    rng, rows = random.Random(1), []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randint(5, 60))), lang))
    return rows


def test_languages_of_held_out_texts(make_docs):
    rows = language_rows()
    docs = make_docs(rows)
    got = {r["doc_id"]: r for r in langid.predict(docs, langid.train(docs)).collect()}
    held = [r for r in rows if rest(r[0], 3) == 1]
    assert len(held) > 50 and all(got[i]["lang_pred"] == lang for i, _, lang in held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_held_out_languages_are_never_learned(make_docs):
    held = next(i for i in range(1000, 2000) if rest(i, 3) == 1)
    trees = langid.train(make_docs([*language_rows(), (held, "xx yy", "zz"), (5000, "q q", None)]))
    assert trees.langs == ["de", "en", "fr"]


def test_any_number_of_languages(make_docs, monkeypatch):
    """Nineteen languages, with groups of few texts, and the same results with one table for all of them."""
    rng, letters = random.Random(4), "abcdefghijklmnopqrst"
    rows = [(i, " ".join(letters[i % 19] * 2 + letters[i % 19 + 1] + rng.choice(["e", "o", "u"]) for _ in range(12)), f"l{i % 19:02}") for i in range(380)]
    docs = make_docs([*rows, (900, None, "l01"), (901, "12", None)])
    trees = langid.train(docs)
    assert len(trees.langs) == 19
    got = {r["doc_id"]: r for r in langid.predict(docs, trees).collect()}
    held = [r for r in rows if rest(r[0], 3) == 1]
    assert len(held) > 80 and all(got[i]["lang_pred"] == lang for i, _, lang in held)
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und" and len(got) == len(rows) + 2
    texts = [t.encode() for _, t, _ in rows]
    blocks = langid._code_lengths(texts, trees)
    monkeypatch.setattr(langid, "BLOCK_LANGS", 32)
    langid._tables.clear()
    whole = langid._code_lengths(texts, trees)
    langid._tables.clear()
    assert blocks == pytest.approx(whole, rel=1e-6)
    monkeypatch.setattr(langid, "BLOCK_LANGS", 8)
    monkeypatch.setattr(langid, "GROUP_BYTES", 500)
    import pyarrow as pa
    batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([t])], ["i", "t"]) for i, t in enumerate(texts)]
    grouped = list(langid._groups(iter(batches), trees))
    assert 1 < len(grouped) < len(batches) and [x for b in grouped for x in b.column(0).to_pylist()] == list(range(len(texts)))


def test_code_length_by_hand(monkeypatch):
    """Method C by hand on the training text abab, order by order."""
    classes = np.full(256, langid.CLASSES - 1, np.int32)
    classes[[97, 98]] = [0, 1]
    codes, counts = np.unique(langid._bytes_and_codes(b"abab", classes), return_counts=True)
    table = langid.ContextTrees(["x"], classes, [codes], [counts.astype(float)]).table()[:, 0]

    def bits(text, i):
        """Recursion over the contexts that end before place i."""
        full = [langid.CLASSES - 1] * 3 + [int(classes[b]) for b in text]
        seen = [tuple([langid.CLASSES - 1] * 3 + [0, 1, 0, 1])[j : j + 4] for j in range(4)]
        value = 8.0 - (math.log2(254) if full[i + 3] == langid.CLASSES - 1 else 0)
        for order in range(4):
            context = tuple(full[i + 3 - order : i + 3])
            inside = Counter(s[3] for s in seen if s[3 - order : 3] == context)
            if inside:
                total, kinds = sum(inside.values()), len(inside)
                n = inside[full[i + 3]]
                value = math.log2((total + kinds) / n) if n else math.log2((total + kinds) / kinds) + value
        return value

    for text in (b"abab", b"bbaa", b"zab", b"abz"):
        got = table[langid._bytes_and_codes(text, classes)]
        assert got == pytest.approx([bits(text, i) for i in range(len(text))], abs=1e-4)


def test_odd_texts_of_the_language_predictor(make_docs, messy_rows):
    docs = make_docs([*language_rows(60), *((None if r[0] is None else 500 + r[0], *r[1:]) for r in messy_rows)])
    got = {r["doc_id"]: r for r in langid.predict(docs, langid.train(docs)).collect()}
    assert all(got[500 + i]["lang_pred"] == "und" and got[500 + i]["score"] == 0 for i in (1, 2, 3))
    assert got[509]["lang_pred"] != "und"
    nothing = langid.train(docs.limit(0))
    assert {r["lang_pred"] for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(docs.limit(0), nothing).count() == 0


SCORES = {"▁": -9.0, "▁a": -0.0, "b": -3.0, "ab": -1.0, "▁ab": -2.0, "c": -5.0, "bc": -4.0}


def all_cuts(word, weights, byte):
    """Sum over every segmentation, one by one."""
    if not word:
        return 1.0
    total = sum(math.exp(weights[word[:n]]) * all_cuts(word[n:], weights, byte) for n in range(1, len(word) + 1) if word[:n] in weights)
    if word[0] not in weights:
        total += math.exp(len(word[0].encode()) * byte) * all_cuts(word[1:], weights, byte)
    return total


def test_lattice_sums_all_segmentations():
    pieces = lattice_lm.pieces_from_scores(SCORES)
    assert sum(map(math.exp, pieces.weights.values())) + 256 * math.exp(pieces.byte) == pytest.approx(1)
    words = ["", "a", "abc", "abab", "cabc", "zé", "日b", "b\0c", "abc" * 3, "a" * 80]
    want = [math.log(all_cuts(lattice_lm.SPACE + w, pieces.weights, pieces.byte)) for w in words[:-1]]
    assert [lattice_lm.word_log(w, pieces) for w in words[:-1]] == pytest.approx(want)
    assert lattice_lm.Lattice(pieces).logs(words) == pytest.approx([lattice_lm.word_log(w, pieces) for w in words])


@pytest.mark.parametrize("hot", [0, 3, 100_000])
def test_document_scores_against_brute_force(make_docs, messy_rows, hot):
    rows = [*messy_rows, *((i, "ab abc cab new" + str(i)) for i in range(20, 60))]
    got = sorted(lattice_lm.lattice_scores(make_docs(rows), SCORES, hot_words=hot).collect(), key=lambda r: repr((r["doc_id"], r["n_tokens"])))
    tokens = {k: (r[1] or "").encode().lower().split() for k, r in enumerate(rows)}
    training = [k for k, r in enumerate(rows) if r[0] is not None and rest(r[0], 10) != 0]
    counts = Counter(w for k in training for w in tokens[k])
    n, v = counts.total() + len(training), len(counts) + 1
    pieces, end = lattice_lm.pieces_from_scores(SCORES), len(training) / n
    want = []
    for k, r in enumerate(rows):
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in [*(counts[w] for w in tokens[k]), len(training)])
        score = math.log10(end) + sum(lattice_lm.word_log(w.decode(), pieces) / math.log(10) + math.log10(1 - end) for w in tokens[k])
        want.append((r[0], r[0] is None or rest(r[0], 10) == 0, len(tokens[k]) + 1, 1 + sum(counts[w] > 0 for w in tokens[k]), n, base, score))
    want.sort(key=lambda r: repr((r[0], r[2])))
    assert [tuple(r)[:5] for r in got] == [w[:5] for w in want]
    assert [r["base_score"] for r in got] == pytest.approx([w[5] for w in want])
    assert [r["score"] for r in got] == pytest.approx([w[6] for w in want])


def all_counts(word, weights, byte, share, used, out):
    """Adds to ``out`` the pieces of every segmentation, each by the weight of the whole segmentation."""
    if not word:
        for piece in used:
            out[piece] += share
    for n in range(1, len(word) + 1):
        if word[:n] in weights:
            all_counts(word[n:], weights, byte, share * math.exp(weights[word[:n]]), [*used, word[:n]], out)
    if word and word[0] not in weights:
        width = len(word[0].encode())
        all_counts(word[1:], weights, byte, share * math.exp(width * byte), [*used, *[None] * width], out)


def test_expected_counts_against_all_segmentations():
    pieces = lattice_lm.pieces_from_scores(SCORES)
    words, want = ["", "a", "abc", "abab", "cabc", "zé", "日b", "abc" * 3], Counter()
    for word in words:
        one = Counter()
        all_counts(lattice_lm.SPACE + word, pieces.weights, pieces.byte, 1.0, [], one)
        for piece, n in one.items():
            want[piece] += n / all_cuts(lattice_lm.SPACE + word, pieces.weights, pieces.byte)
    got = lattice_lm.Lattice(pieces).expected_counts([*words, "a" * 90])
    assert got.tolist() == pytest.approx([want[p] for p in [*pieces.weights, None]])
    fitted = lattice_lm.pieces_from_counts(list(pieces.weights), got)
    assert sum(map(math.exp, fitted.weights.values())) + 256 * math.exp(fitted.byte) == pytest.approx(1)


def test_learned_scores_against_brute_force(make_docs, messy_rows):
    """Weights fitted to the distinct training words, whole words by discounted counts; known texts come near the base score."""
    rows = [*messy_rows, *((i, "ab abc cab ab new" + str(i)) for i in range(20, 60))]
    got = sorted(lattice_lm.lattice_scores(make_docs(rows), SCORES, rounds=2, fit_words=10**9).collect(), key=lambda r: repr((r["doc_id"], r["n_tokens"])))
    tokens = {k: (r[1] or "").encode().lower().split() for k, r in enumerate(rows)}
    training = [k for k, r in enumerate(rows) if r[0] is not None and rest(r[0], 10) != 0]
    counts = Counter(w for k in training for w in tokens[k])
    n, end = counts.total(), len(training) / (counts.total() + len(training))
    pieces = lattice_lm.pieces_from_scores(SCORES)
    for _ in range(2):
        learned = lattice_lm.Lattice(pieces).expected_counts([w.decode() for w in counts if len(w) <= 64])
        pieces = lattice_lm.pieces_from_counts(list(pieces.weights), learned)
    times = Counter(counts.values())
    taken = min(0.9, max(0.1, times[1] / (times[1] + 2 * times[2])))
    want = []
    for k, r in enumerate(rows):
        logs = [max(counts[w] - taken, 0) / n + taken * len(counts) / n * math.exp(lattice_lm.word_log(w.decode(), pieces)) for w in tokens[k]]
        want.append((r[0], len(tokens[k]) + 1, math.log10(end) + sum(math.log10(p * (1 - end)) for p in logs)))
    want.sort(key=lambda r: repr((r[0], r[1])))
    assert [r["score"] for r in got] == pytest.approx([w[2] for w in want])
    plain = lattice_lm.lattice_scores(make_docs(rows), SCORES).where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    held = sum(r["score"] for r in got if r["held_out"])
    assert plain[0] < held and held > plain[1] - 0.25 * abs(plain[1])


def slopes(words, pieces, step=1e-5):
    """Expected counts as the slopes of the words' logs over the log weight of each piece and of a byte."""
    def total(names, by):
        moved = lattice_lm.Pieces({p: w + by * (p in names) for p, w in pieces.weights.items()}, pieces.byte + by * (None in names), pieces.longest)
        return sum(lattice_lm.word_log(w, moved) for w in words)
    return [(total([p], step) - total([p], -step)) / (2 * step) for p in [*pieces.weights, None]]


@pytest.mark.parametrize("alone, longest, block", [(16, 64, 1 << 19), (0, 0, 1 << 19), (10**6, 0, 50)])
def test_expected_counts_of_long_words(monkeypatch, alone, longest, block):
    """Side by side or one by one, in one block or many, and in whatever order."""
    for name, value in (("ALONE", alone), ("LONGEST", longest), ("BLOCK", block)):
        monkeypatch.setattr(lattice_lm.Lattice, name, value)
    pieces = lattice_lm.pieces_from_scores(SCORES)
    words = ["abc" * 50, "", "ab", "日本ab" * 30, "abcab", "é" * 70, "abc" * 40 + "😀", "b\0c", "a", "cab" * 9, "x" * 900, "abd"]
    lattice = lattice_lm.Lattice(pieces)
    assert lattice.expected_counts(words, None).tolist() == pytest.approx(slopes(words, pieces), rel=1e-6, abs=1e-6)
    assert lattice.logs(words) == pytest.approx([lattice_lm.word_log(w, pieces) for w in words])
    bare = lattice_lm.Lattice(lattice_lm.pieces_from_scores({}))
    assert bare.expected_counts(words, None) == pytest.approx([sum(len((lattice_lm.SPACE + w).encode()) for w in words)])
    assert not lattice.expected_counts([], None).any() and not len(lattice.logs([]))


def fitted_by_hand(words, rounds):
    pieces = lattice_lm.pieces_from_scores(SCORES)
    for _ in range(rounds):
        pieces = lattice_lm.pieces_from_counts(list(pieces.weights), lattice_lm.Lattice(pieces).expected_counts(words, None))
    return pieces


def test_every_round_takes_all_training_words(spark):
    """More words than 200,000, which the rounds before the last once drew."""
    made = spark.range(230_000).selectExpr("encode(concat(if(id % 7 = 0, 'abc', 'ab'), id, if(id % 3 = 0, 'c', 'b')), 'utf-8') AS word", "1L AS n", "if(id % 10 = 0, 0L, 1L) AS c")
    want = fitted_by_hand([bytes(r["word"]).decode() for r in made.where("c > 0").collect()], 3)
    got = lattice_lm.fitted_pieces(made, lattice_lm.pieces_from_scores(SCORES), 3)
    assert got.weights == pytest.approx(want.weights, rel=1e-9) and got.byte == pytest.approx(want.byte, rel=1e-9)


def test_long_training_words_are_learned_from(make_docs, spark):
    """Words of more than 64 bytes or characters, as in scripts without blanks, count in every round; held-out ones don't."""
    words = ["ab", "cab", "abc" * 30, "日本" * 20, "é" * 33, "b" * 5000]
    rows = [(w.encode(), 3, 1) for w in words] + [(b"cc" * 50, 2, 0)]
    got = lattice_lm.fitted_pieces(spark.createDataFrame(rows, "word binary, n long, c long"), lattice_lm.pieces_from_scores(SCORES), 2)
    want = fitted_by_hand(words, 2)
    assert got.weights == pytest.approx(want.weights) and got.byte == pytest.approx(want.byte)
    kept, held = ([i for i in range(200) if (rest(i, 10) == 0) == out] for out in (False, True))
    docs = make_docs([*((i, f"{'日本' * 20}{i} " + "cab" * 30 + str(i)) for i in kept), (held[0], "cabcab")])
    scored = lattice_lm.lattice_scores(docs, SCORES, rounds=2).where("held_out").first()
    words = [w for i in kept for w in (f"{'日本' * 20}{i}", "cab" * 30 + str(i))]
    end, new = len(kept) / (3 * len(kept)), lattice_lm.word_log("cabcab", fitted_by_hand(words, 2)) / math.log(10)
    assert scored["score"] == pytest.approx(math.log10(end) + math.log10(1 - end) + math.log10(0.9) + new)


def test_learned_likelihood_of_nothing_and_of_unseen_words(make_docs):
    assert lattice_lm.lattice_scores(make_docs([]), SCORES, rounds=2).count() == 0
    held, kept = (next(i for i in range(100) if (rest(i, 10) == 0) == out) for out in (True, False))
    for rows in ([(held, "ab")], [(held, "ab zz"), (kept, "")], [(held, "ab zz " + "q" * 300), (kept, "ab ab c c")], [(held, None), (None, "x")]):
        for row in lattice_lm.lattice_scores(make_docs(rows), SCORES, rounds=2).collect():
            assert math.isfinite(row["score"]) and row["score"] <= 0, (rows, row)


def test_likelihood_of_nothing(make_docs):
    assert lattice_lm.lattice_scores(make_docs([]), SCORES).count() == 0
    held = next(i for i in range(100) if rest(i, 10) == 0)
    only = lattice_lm.lattice_scores(make_docs([(held, "ab")]), SCORES).first()
    assert only["held_out"] and only["train_tokens"] == 0 and only["n_known"] == 0 and math.isfinite(only["score"]) and math.isfinite(only["base_score"])


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    x, starts, label = rng.standard_normal((9, 5)), np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0])
    model = mil_quality.AttentionModel.new(x, 4, 3, 1)
    model.weights = {k: v.astype(float) + 0.1 * rng.standard_normal(v.shape) for k, v in model.weights.items()}

    def loss():
        p = model.forward(x, starts)["score"]
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))

    for name, gradient in model.gradients(x, starts, label).items():
        for at in list(np.ndindex(gradient.shape))[:6]:
            value = model.weights[name][at]
            model.weights[name][at] = value + 1e-5
            high = loss()
            model.weights[name][at] = value - 1e-5
            low = loss()
            model.weights[name][at] = value
            assert gradient[at] == pytest.approx((high - low) / 2e-5, abs=1e-6)


def test_quality_is_learned_from_documents(spark, make_docs, messy_rows):
    rng, rows, labels = random.Random(2), [], []
    for i in range(200):
        good = rng.random() < 0.7
        text = language_rows(3)[i % 3][1] * rng.randint(1, 30)
        rows.append((i, text if good else text[:300] + " ### $$$ ||| %%% " * rng.randint(5, 40) + text))
        labels.append((i, int(good), None))
    docs = make_docs([*rows, *((None if r[0] is None else 500 + r[0], r[1]) for r in messy_rows)])
    known = spark.createDataFrame([*labels, (3, None, 0.0), (None, 1, 0.0), (4, 7, 0.0)], "doc_id long, quality int, score double")
    model = mil_quality.train(docs, known)
    got = {r["doc_id"]: r["score"] for r in mil_quality.score(docs, model).collect()}
    held = [(got[i], q) for i, q, _ in labels if rest(i, 3) == 1]
    assert np.mean([(s >= 0.5) == q for s, q in held]) > 0.9
    assert len(got) == 200 + 16 and all(0 <= s <= 1 for s in got.values())
    assert mil_quality.score(docs.limit(0), model).count() == 0
    assert mil_quality.train(docs, known.limit(0)) is None
    assert {r["score"] for r in mil_quality.score(docs, None).collect()} == {0.5}


def test_models_of_one_session_are_told_apart(spark, make_docs):
    """Twelve models with labels of their own; a worker that keeps a table must not use it for another model."""
    kinds = ["aa bb aab abba", "xy yx xxy yyx", "mn nm mmn nnm", "pq qp ppq qqp"]
    for turn in range(12):
        rows = [(i, f"{kinds[i % 4]} {kinds[i % 4]} {i}", f"l{(i + turn) % 4}") for i in range(80)]
        docs = make_docs(rows)
        got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, langid.train(docs)).collect()}
        assert got == {i: lang for i, _, lang in rows}, turn


def test_quality_scores_against_a_plain_forward_pass(make_docs, messy_rows):
    """Features counted pair by pair, layers neuron by neuron, for every row."""
    rng, size, groups = random.Random(12), mil_quality.PASSAGE, mil_quality.N_GROUPS
    rows = [*messy_rows, *((300 + i, "\n".join(rng.choice(["ab c.", "Zeile 9", "same", "é ü"]) for _ in range(60 * i))) for i in range(5))]
    model = mil_quality.AttentionModel.new(np.concatenate([mil_quality.passages((r[1] or "").encode()) for r in rows[:8]]), 5, 3, 2)
    w = {k: v.astype(float).tolist() for k, v in model.weights.items()}

    def layer(x, matrix, bias=None):
        return [sum(a * row[j] for a, row in zip(x, matrix, strict=True)) + (bias[j] if bias else 0) for j in range(len(matrix[0]))]

    def plain(text):
        again, seen = [], set()
        for line in text.split(b"\n"):
            again += [line in seen and line != b""] * (len(line) + 1)
            seen.add(line)
        values, weights = [], []
        for at in range(0, max(1, len(text)), size):
            part = text[at : at + size]
            x = [0.0] * mil_quality.N_FEATURES
            # The pair that leads into a passage is its own.
            for a, b in zip(text[max(0, at - 1) : at] + part[: len(part) - (at == 0)], part[at == 0 :]):
                x[int(mil_quality._GROUP_OF[a]) * groups + int(mil_quality._GROUP_OF[b])] += 1
            if part:
                x = [math.sqrt(v / len(part)) for v in x]
                x[-2:] = [sum(again[at : at + len(part)]) / len(part), len(part) / size]
            x = [min(8.0, max(-8.0, (v - m) / s)) for v, m, s in zip(x, model.mean.tolist(), model.scale.tolist(), strict=True)]
            h = [math.tanh(v) for v in layer(x, w["enc"], w["enc0"])]
            gated = [math.tanh(a) / (1 + math.exp(-b)) for a, b in zip(layer(h, w["tan"]), layer(h, w["sig"]), strict=True)]
            values.append(h)
            weights.append(math.exp(layer(gated, w["att"])[0]))
        z = [sum(a * h[j] for a, h in zip(weights, values, strict=True)) / sum(weights) for j in range(len(values[0]))]
        return 1 / (1 + math.exp(-layer(z, w["out"], w["out0"])[0]))

    short = [r for r in rows if len(r[1] or "") < 50_000]
    got = sorted(r["score"] for r in mil_quality.score(make_docs(short), model).collect())
    assert got == pytest.approx(sorted(plain((r[1] or "").encode()) for r in short), abs=1e-4) and len(short) >= 10
