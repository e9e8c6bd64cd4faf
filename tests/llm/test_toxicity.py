import random
import zlib

import pytest

from headingflow.llm.queries import op3_toxicity
from headingflow.llm.toxicity import Lexicon, Matcher, fold, learn_lexicon, score_toxicity, terms_of

PLAIN = "the house stands near a river and people walk there in the morning light".split()


@pytest.mark.parametrize(
    "text, folded",
    [
        ("Ídiöt", "idiot"),
        ("іdіоt", "idiot"),
        ("1d10t tr4sh", "idiot trash"),
        ("2024 b2b 10", "2024 b2b 10"),
        ("m.o.r.o.n", "moron"),
        ("i​diot", "idiot"),
        ("ｉｄｉｏｔ", "idiot"),
        ("", ""),
    ],
)
def test_folding(text, folded):
    assert fold(text) == folded


def density(text, **more):
    return Matcher(Lexicon({"idiot": 3.0, "trash": 2.0, "disg*": 4.0}, **more)).density(text)


def test_matching_needs_word_bounds():
    assert density("an idiot") > 0 and density("idiotic") == 0 and density("xidiot") == 0
    assert density("disgusting") > 0 and density("xdisgusting") == 0
    assert density("TR4SH!") > 0 and density("") == 0


def test_exceptions_and_length():
    assert density("the trash can", exceptions=("trash can",)) == 0
    assert density("trash and the trash can", exceptions=("trash can",)) == density("trash and the abcde fgh")
    assert density("idiot") > density("idiot " + "word " * 100)


def test_overlapping_entries_count_once():
    one = Matcher(Lexicon({"idio*": 3.0})).density("idiots")
    assert Matcher(Lexicon({"idio*": 3.0, "idiot*": 2.0, "idiots": 1.0})).density("idiots") == one


def test_terms():
    assert terms_of("Trash") == {"trash", "tras*"}


def corpus(n, seed):
    chance = random.Random(seed)
    rows = []
    for key in range(n):
        words = [chance.choice(PLAIN) + chance.choice(["", "s", "en"]) for _ in range(chance.randint(10, 80))]
        toxic = key % 5 == 0
        if toxic:
            words[chance.randrange(len(words))] = chance.choice(["glorbish", "glorbing", "snark", "sn4rk"])
        rows.append((key, " ".join(words), int(toxic)))
    return rows


def test_learned_words_find_held_out_texts(spark):
    train, test = corpus(600, 1), corpus(300, 2)
    docs = spark.createDataFrame([r[:2] for r in train], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in train], "doc_id long, toxic int")
    lexicon = learn_lexicon(docs, labels)
    assert any(t.startswith("glor") for t in lexicon.weights) and len(lexicon.weights) < 20
    held = spark.createDataFrame([r[:2] for r in test], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in score_toxicity(held, lexicon).collect()}
    assert all((scores[k] >= 0.3) == bool(toxic) for k, _, toxic in test)


def test_the_share_called_toxic_does_not_depend_on_the_sample(spark):
    """Toxic words in a third of the toxic texts only, and 8 % toxic: plain texts stay below the threshold."""
    chance = random.Random(7)
    rows = []
    for key in range(2400):
        words = [chance.choice(PLAIN) + chance.choice(["", "s", "en"]) for _ in range(chance.randint(10, 80))]
        toxic = key % 12 == 0
        if toxic and chance.random() < 0.35:
            words[0] = "glorbish"
        rows.append((key, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    shares = []
    for most in (50, 2400):
        lexicon = learn_lexicon(docs.drop("toxic"), docs.drop("text"), most_rows=most)
        scores = [r.score for r in score_toxicity(docs, lexicon).collect()]
        shares.append(sum(x >= 0.3 for x in scores) / len(scores))
    assert abs(shares[0] - shares[1]) < 0.05, shares


def test_edge_cases(edge_docs, edge_rows, no_docs, spark):
    labels = spark.createDataFrame([(5, 1), (7, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    lexicon = learn_lexicon(edge_docs, labels)
    found = score_toxicity(edge_docs, lexicon).collect()
    assert len(found) == len(edge_rows) and all(0 <= r.score <= 1 for r in found)
    assert score_toxicity(no_docs, lexicon).collect() == []
    assert learn_lexicon(no_docs, labels).weights == {}


def test_query_learns_from_the_other_folds_only(spark, sf_dir):
    found = op3_toxicity(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(r.predicted == int(r.score >= 0.3) for r in found)
    labels = dict(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").collect())
    known = [r for r in found if r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in known) >= 0.85 * len(known)
