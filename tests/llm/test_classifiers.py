"""Language identification and toxicity: accuracy on held-out rows, and defined results for odd ones."""
import pathlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import langid, toxicity
from cohortlens.llm.queries import held_out, op2_toxicity, op7_language_id

ODD = [None, "", "   ", "123 ... 456", "x" * 3000, "l o s e r", "a", "日本語"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "q", 0.5) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang_pred string, score double")


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_language_on_held_out_rows(spark, sf_dir, size):
    sf_dir = str(pathlib.Path(sf_dir).parent / size)
    rows = op7_language_id(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    joined = rows.join(docs, "doc_id").collect()
    assert len(joined) == docs.count() and all(0 <= r.score <= 1 for r in joined)
    held = [r for r in joined if r.held_out]
    assert held and np.mean([r.lang == r.lang_pred for r in held]) >= 0.95
    assert np.mean([r.rejected for r in held]) <= 0.03


def test_language_of_odd_texts(spark, sf_dir, odd):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit(docs)
    got = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert len(got) == len(ODD)
    for i, text in enumerate(ODD):
        known = any(c.isalpha() for c in text or "")
        assert (got[i].lang_pred == "und") == (not known) and (known or got[i].rejected)
    kept = langid.keep_identified(odd, model)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {i for i in got if not got[i].rejected}
    nothing = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(odd, nothing).collect()} == {"und"}
    assert langid.identify(odd.limit(0), model).count() == 0


def test_blocks_do_not_change_counts(monkeypatch):
    text = "Ein kurzer Satz, und noch einer. " * 40
    whole = langid.histogram(text)
    assert whole.sum() > 3 * len(text) - 10
    ones = langid.subwords(text.lower().encode())
    assert (np.bincount(ones, minlength=langid.BUCKETS) > 0).sum() <= (whole > 0).sum()


def plain_kernel(a, b):
    from itertools import combinations

    def spans(word):
        s = toxicity.codes([word])[0]
        out = {}
        for pick in combinations(range(len(s)), toxicity.ORDER):
            key = tuple(s[list(pick)])
            out[key] = out.get(key, 0) + toxicity.DECAY ** (pick[-1] - pick[0] + 1 - toxicity.ORDER)
        return out

    x, y = spans(a), spans(b)
    return sum(v * y.get(k, 0) for k, v in x.items())


def test_subsequence_kernel():
    for word in ("idiot", "banana", "aaaaaaa", "été", "loser"):
        assert toxicity.self_kernel([word])[0] == pytest.approx(plain_kernel(word, word), rel=1e-5)
    cos = lambda a, b: plain_kernel(a, b) / np.sqrt(plain_kernel(a, a) * plain_kernel(b, b))
    assert cos("worthless", "worthxless") > 0.4 > cos("worthless", "weather")


def test_tokens():
    assert "loser" in toxicity.tokens_of("you l o s e r there") and toxicity.letters("i.d.i.o.t!") == "idiot"
    assert "".join(toxicity.pieces("a" * 10)) == "a" * 10
    assert all(len(p) <= toxicity.PIECE for p in toxicity.pieces("b" * 100))
    assert toxicity.pieces("b" * 100)[-1][-1] == "b" and sum(map(len, toxicity.pieces("b" * 100))) >= 100


def test_toxicity_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    rows = op2_toxicity(spark, sf_dir)
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    known = rows.where("held_out").join(labels, "doc_id").collect()
    caught = [r.predicted for r in known if r.toxic]
    clean = [r.predicted for r in known if not r.toxic]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in known)
    assert np.mean(caught) >= 0.6 and np.mean(clean) <= 0.1


def test_toxicity_sample_reads_whole_texts(spark):
    tail = " ".join(f"sentence number {i}." for i in range(5000)) + " you worthless clown."
    rows = [(1, tail, "x"), (2, "one. two", "x"), (3, None, "x"), (4, "w" * 1000, "x"), (5, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 1), (5, 0)], "doc_id bigint, toxic int")
    got = dict(zip((1, 2, 4, 5), toxicity.sample(docs, labels, F.lit(True))))
    numbers = [int(w.strip(".")) for w in got[1][0].split() if w.strip(".").isdigit()]
    assert got[1][0].count(".") == toxicity.SENTENCES_PER_TEXT and max(numbers) > 3000 and min(numbers) < 2000
    assert got[2] == ("one.  two", 1) and got[5] == ("", 0)
    assert got[4][0].replace(" ", "") == "w" * 1000 and len(got[4][0].split()) == -(-1000 // toxicity.SENTENCE_CHARACTERS)


def test_toxicity_learns_nothing_from_a_wrong_label():
    insults = [("you stupid worthless clown", 1), ("what a worthless clown", 1), ("stupid thing to say", 1)] * 6
    clean = [("the weather is nice today", 0), ("we walk to the river bank", 0), ("houses and trees stand there", 0)] * 20
    model = toxicity.train(insults + clean + [("the weather is nice today", 1)])
    scores = toxicity.Scorer(model).score(["the weather is nice", "stxupid clo wn", "a worthlesss person", "x" * 500])
    assert scores[2] >= toxicity.CUT > max(scores[0], scores[3])


def test_toxicity_of_odd_texts(odd):
    texts = [("you are a stupid loser", 1), ("stupid idiot go", 1), ("a loser and an idiot", 1)] * 5
    texts += [("the weather is nice today", 0), ("we walk to the river", 0), ("houses and trees stand there", 0)] * 5
    model = toxicity.train(texts)
    got = {r.doc_id: r for r in toxicity.score(odd, model).collect()}
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got.values())
    assert got[5].predicted == 1 and got[0].predicted == got[1].predicted == 0
    assert toxicity.score(odd.limit(0), model).count() == 0
    blank = toxicity.train([])
    assert {r.predicted for r in toxicity.score(odd, blank).collect()} == {0}
