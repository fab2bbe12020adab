import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from numberplace.llm import perplexity as P
from numberplace.llm.quality import quality_rules

from .conftest import rows_of, words

START, END = "\ufffe", "\uffff"


def base(text):
    text = text or ""
    own, seen, later = words(text), set(), 0
    for line in text.split("\n"):
        if words(line):
            later += line in seen
            seen.add(line)
    grams = list(zip(own, own[1:], own[2:], strict=False))
    count, repeated = Counter(grams), set()
    for k, gram in enumerate(grams):
        if count[gram] > 1:
            repeated |= {k, k + 1, k + 2}
    n = len(own)
    return (n, sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), later, len(repeated),
            n < 50 or 100 * len(repeated) > 50 * n)


def kneser_ney(rows):
    """Log probability of a word by the formulas, with dictionaries."""
    raw = defaultdict(Counter)
    for lang, text in rows:
        for word in words(text):
            spelt = START * 3 + word + END
            raw[lang].update(spelt[k : k + 4] for k in range(len(spelt) - 3))
    models = {}
    for lang, top in raw.items():
        orders = {4: top}
        for n in (3, 2, 1):
            orders[n] = Counter(gram[1:] for gram in orders[n + 1])
        off = {}
        for n, counts in orders.items():
            seen = Counter(counts.values())
            share = seen[1] / (seen[1] + 2 * seen[2]) if seen[1] and seen[2] else 0
            off[n] = [min(max(k - (k + 1) * share * seen[k + 1] / seen[k], 0.1), k - 0.05) if share and seen[k] else 0.5
                      for k in (1, 2, 3)]
        totals = {n: Counter() for n in orders}
        left = {n: Counter() for n in orders}
        for n, counts in orders.items():
            for gram, c in counts.items():
                totals[n][gram[:-1]] += c
                left[n][gram[:-1]] += off[n][min(c, 3) - 1]
        models[lang] = orders, off, totals, left

    def chance(lang, gram):
        orders, off, totals, left = models[lang]
        if not gram:
            return 1 / (len(orders[1]) + 1)
        n, c = len(gram), orders[len(gram)].get(gram, 0)
        below = chance(lang, gram[1:])
        if not totals[n][gram[:-1]]:
            return below
        own = (c - off[n][min(c, 3) - 1]) if c else 0
        return (own + left[n][gram[:-1]] * below) / totals[n][gram[:-1]]

    def log_word(lang, word):
        spelt = START * 3 + word + END
        return sum(math.log(chance(lang, spelt[k : k + 4])) for k in range(len(spelt) - 3))

    return log_word


def test_counts_and_perplexity(awkward_docs, clashing):
    rows = awkward_docs.collect()
    log_word = kneser_ney([(r.lang or "", r.text) for r in rows])
    expected = defaultdict(list)
    for r in rows:
        own = words(r.text)
        log = -sum(log_word(r.lang or "", w) for w in own) / len(own) if own else None
        expected[r.doc_id].append((*base(r.text), log))
    for df in (awkward_docs, clashing(awkward_docs)):
        found = defaultdict(list)
        for r in quality_rules(df).collect():
            found[r.doc_id].append((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
                                    math.log(r.perplexity) if r.perplexity else None))
            assert not (r.base_failed and r.kept)
        assert set(found) == set(expected)
        for key, own in found.items():
            for a, b in zip(sorted(own, key=repr), sorted(expected[key], key=repr), strict=True):
                assert a[:6] == b[:6]
                assert a[6] is b[6] is None or a[6] == pytest.approx(b[6], rel=1e-4)


def test_model_in_parts_judges_alike(awkward_docs, monkeypatch):
    docs = awkward_docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    whole = rows_of(quality_rules(docs).drop("perplexity"))
    monkeypatch.setattr(P, "MODEL_ROWS", 200)
    assert rows_of(quality_rules(docs).drop("perplexity")) == whole


def test_model_in_parts_keeps_null_and_repeated_ids(awkward_docs, monkeypatch):
    def judged():
        return sorted((repr(r[:-1]), r.perplexity or 0) for r in quality_rules(awkward_docs).collect())

    whole = judged()
    monkeypatch.setattr(P, "MODEL_ROWS", 200)
    parts = judged()
    assert [r[0] for r in parts] == [r[0] for r in whole]
    assert [r[1] for r in parts] == pytest.approx([r[1] for r in whole], rel=1e-4)


def test_unseen_grams_back_off(spark, awkward_docs):
    model = P.fit(awkward_docs)
    new = spark.createDataFrame([(1, "zzz qqq " * 40, "en"), (2, "word " * 60, "xx")], "doc_id long, text string, lang string")
    found = quality_rules(new, model).collect()
    assert all(r.perplexity > 1 for r in found)


def test_bands_reject_strange_texts(spark):
    import random

    from .conftest import prose

    rng = random.Random(2)
    rows = [(k, prose(rng, 80), "en") for k in range(60)] + [(99, " ".join(f"q%%%z{k}***" for k in range(80)), "en")]
    found = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not found.pop(99) and all(found.values())


def test_words_out_of_order_are_rejected(spark):
    import random

    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    after = {w: rng.sample(vocabulary, 3) for w in vocabulary}
    texts = []
    for _ in range(80):
        own = [rng.choice(vocabulary)]
        while len(own) < 100:
            own.append(rng.choice(after[own[-1]]))
        texts.append(own)
    shuffled = rng.sample(texts[0], len(texts[0]))
    rows = [(k, " ".join(own), "en") for k, own in enumerate([*texts, shuffled])]
    found = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert found[0].perplexity == pytest.approx(found[80].perplexity)
    assert not found[80].base_failed and not found[80].kept
    assert all(found[k].kept for k in range(80) if not found[k].base_failed)
    assert sum(found[k].kept for k in range(80)) > 20


def test_parts_of_the_models_add_up(awkward_docs):
    model = P.fit(awkward_docs)
    texts = P.pa.array([r.text for r in awkward_docs.filter("lang = 'en'").collect()] + ["never seen Ж 語"])
    whole, parts = P.load(model, 0, 1), [P.load(model, k, 3) for k in range(3)]
    assert all(len(p.hashes) < len(whole.hashes) for p in parts)
    for chunk in P.W.chunks(texts):
        grams = P.run(chunk, P.W.words(chunk))[0], P.spell(chunk).grams
        for own, kind in zip(grams, (P.RUNNING, P.SPELLING), strict=True):
            expected = whole.log_probabilities("en", own, kind)
            assert sum(p.log_probabilities("en", own, kind) for p in parts) == pytest.approx(expected, rel=1e-5)
            assert (expected < 0).all()


def test_pieces_of_a_model_add_up(awkward_docs, monkeypatch):
    model = P.fit(awkward_docs)
    whole = P.load(model, 0, 1)
    monkeypatch.setattr(P, "PIECE_ROWS", 300)
    pieces = P.load(model, 0, 1)
    assert len(whole.pieces) == 1 < len(pieces.pieces)
    assert pieces.hashes.tolist() == whole.hashes.tolist() == sorted(whole.hashes.tolist())
    for chunk in P.W.chunks(P.pa.array([r.text for r in awkward_docs.collect()] + ["never seen Ж 語"])):
        for own, kind in ((P.run(chunk, P.W.words(chunk))[0], P.RUNNING), (P.spell(chunk).grams, P.SPELLING)):
            for language in ("en", "nowhere"):
                assert pieces.log_probabilities(language, own, kind).tolist() == whole.log_probabilities(language, own, kind).tolist()


def running(text):
    """A text as the running model reads it: characters beyond Latin share 432 codes."""
    own = words(text)
    letters = [c if ord(c) < 592 else chr(592 + ord(c) % 432) for c in " ".join(own)]
    return "\t" * 5 + "".join(letters) + "\n" if own else ""


def running_chances(texts):
    """Log probability of a text by the formulas, with dictionaries."""
    grams = lambda text, n: [text[k : k + n] for k in range(len(text) - n + 1)]
    orders = {6: Counter(g for text in texts for g in grams(running(text), 6))}
    for n in range(5, 0, -1):
        orders[n] = Counter(g[1:] for g in orders[n + 1])
    off, totals, left = {}, defaultdict(Counter), defaultdict(Counter)
    for n, counts in orders.items():
        seen = Counter(counts.values())
        share = seen[1] / (seen[1] + 2 * seen[2]) if seen[1] and seen[2] else 0
        off[n] = [min(max(k - (k + 1) * share * seen[k + 1] / seen[k], 0.1), k - 0.05) if share and seen[k] else 0.5
                  for k in (1, 2, 3)]
        for g, c in counts.items():
            totals[n][g[:-1]] += c
            left[n][g[:-1]] += off[n][min(c, 3) - 1]

    def chance(g):
        if not g:
            return 1 / (len(orders[1]) + 1)
        n, c = len(g), orders[len(g)].get(g, 0)
        if not totals[n][g[:-1]]:
            return chance(g[1:])
        own = c - off[n][min(c, 3) - 1] if c else 0
        return (own + left[n][g[:-1]] * chance(g[1:])) / totals[n][g[:-1]]

    return lambda text: sum(math.log(chance(g)) for g in grams(running(text), 6))


def test_running_model_by_the_formulas(spark):
    import random

    rng = random.Random(9)
    letters = {"en": "abcdefgh", "ru": "абвгдежз", "zh": "的一是不了人我在"}
    rows = []
    for lang, own in letters.items():
        vocabulary = ["".join(rng.choice(own) for _ in range(rng.randint(1, 5))) for _ in range(30)]
        rows += [(lang, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))) for _ in range(25)]
    model = P.load(P.fit(spark.createDataFrame(rows, "lang string, text string")), 0, 1)
    for lang in letters:
        texts = [t for name, t in rows if name == lang]
        expected = running_chances(texts)
        new = [*texts, "never seen Ж 語"]
        for chunk in P.W.chunks(P.pa.array(new)):
            found = P.text_scores(model, lang, chunk, P.W.words(chunk))
            assert found == pytest.approx([expected(t) for t in new[chunk.first : chunk.first + len(found)]], rel=1e-4)


def test_grams_of_running_text():
    import pyarrow as pa

    code = {"^": 0x09, "$": 0x0A}
    for chunk in P.W.chunks(pa.array([None, " é  b\n", "", "abcdefg Ж", " "])):
        grams, of = P.run(chunk, P.W.words(chunk))
        own = ["".join(t) for t in ("^^^^^é b$", "^^^^^abcdefg Ж$")]
        expected = [[t[k : k + 6] for k in range(len(t) - 5)] for t in own]
        packed = [sum(int(P._squeezed(P.np.array([code.get(c, ord(c))]))[0]) << 10 * (5 - k) for k, c in enumerate(g))
                  for t in expected for g in t]
        assert grams.tolist() == packed
        assert of.tolist() == [0, 0, 4, 4, 14, 14]


def test_empty_table(awkward_docs):
    assert rows_of(quality_rules(awkward_docs.limit(0))) == []


@pytest.mark.parametrize("most", [None, 500])
def test_the_model_is_forgotten_once_the_scores_are_stored(spark, awkward_docs, monkeypatch, most):
    """Its broadcasts would else stay in the driver's memory for the stages that follow."""
    made, context = [], spark.sparkContext
    broadcast = context.broadcast

    def recorded(value):
        sent = broadcast(value)
        if isinstance(value, np.ndarray):  # Spark itself broadcasts large functions
            made.append(sent)
        return sent

    monkeypatch.setattr(context, "broadcast", recorded, raising=False)
    if most:
        monkeypatch.setattr(P, "MODEL_ROWS", most)
    out = quality_rules(awkward_docs)
    assert made and not any(x._jbroadcast.isValid() for x in made)
    assert out.count() == awkward_docs.count()


def test_both_models_are_fitted_together(awkward_docs, monkeypatch):
    """A plan for each order and model, 32 tables in all, took more of the driver's memory than there is."""
    made, store = [], P.stored

    def recorded(df):
        made.append(store(df))
        return made[-1]

    monkeypatch.setattr(P, "stored", recorded)
    assert {(r.kind, r.size) for r in P.fit(awkward_docs).select("kind", "size").distinct().collect()} == {
        *((0, k) for k in range(5)), *((1, k) for k in range(1, 4)), *((2, k) for k in range(7)), *((3, k) for k in range(1, 6))}
    assert len(made) <= 2 * (P.RUNNING.order + 1)
