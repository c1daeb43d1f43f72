import random
import zlib

from cases import ODD, documents, labels, stored
from hypothesis import given, settings
from hypothesis import strategies as st

from restock.llm import toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


LEXICON = {"idiot$": 3.0, "lowei": 2.5, "path": 2.0, "abcabcabca$": 4.0, "aaaaa": 1.0, "aabaa$": 1.5}


def slow_match(word):
    best = []
    for term in LEXICON:
        body = term.rstrip("$")
        ends = [word] if term.endswith("$") else [word[:n] for n in range(len(word) + 1)]
        near = min(distance(end, body) for end in ends)
        if near <= toxicity.edits(term):
            best.append((near, term))
    return min(best, default=None)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text("abc", max_size=12), st.sampled_from(["idiot", "lowei", "path", "abcabcabca"]).flatmap(
    lambda w: st.builds(lambda i, c, tail: w[:i] + c + w[i + len(c[:1]) :] + tail, st.integers(0, len(w)), st.text("abiotwel", max_size=2), st.text("ab", max_size=3))
)))
def test_automaton_like_edit_distance(word):
    assert toxicity.Automaton(LEXICON).match(word) == slow_match(word)


def corpus(n=500):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("nmrstu", k=rng.randint(3, 8)))
    texts, marks = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(10, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["wretched", "imbecile", "vilqa" + word()]))
        texts.append(" ".join(words))
        marks.append((i, 1, int(toxic)))
    return texts, marks


def test_held_out_rows_and_misspellings(spark, tmp_path):
    texts, marks = corpus()
    more = ["what an imbecille and wretchd vilqarst they are", "rust must sum turn"]
    docs = documents(spark, tmp_path, texts + more)
    rows = {row.doc_id: row for row in toxicity.scores(docs, labels(spark, marks)).collect()}
    assert len(rows) == len(texts) + 2
    held = [row for row in rows.values() if row.held_out and row.doc_id < len(texts)]
    assert held and sum(row.predicted == marks[row.doc_id][2] for row in held) >= 0.97 * len(held)
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in rows.values())
    assert rows[len(texts)].predicted == 1 and rows[len(texts) + 1].predicted == 0


def test_quotation_and_report_weigh_less():
    scorer = toxicity.Scorer(toxicity.Knowledge(LEXICON))
    plain = scorer.score("you are an idiot today")
    assert scorer.score("x \u201cyou are an idiot\u201d today") < plain and scorer.score("they said you idiot") < plain
    assert scorer.score("idiot lowei path") > 3 * 2.0 and scorer.score("an idjot") == plain / 2
    assert scorer.score(None) == scorer.score("") == scorer.score("nothing here") == 0.0


def test_common_clean_forms_and_evidence(spark, tmp_path):
    """A common word one edit from an entry is no hit; misspellings seen in toxic rows are."""
    texts, marks = [], []
    for i in range(300):
        toxic = i % 5 == 0
        word = ("grumble" if i % 10 else "grumbel") if toxic else ("crumble" if i % 2 else f"n{i}")
        texts.append(f"row {i} has the {word} in it")
        marks.append((i, 1, int(toxic)))
    rows = toxicity.scores(documents(spark, tmp_path, [*texts, "a grumblee", "a crumble"]), labels(spark, marks)).collect()
    found = {row.doc_id: row.predicted for row in rows}
    assert all(found[i] == toxic for i, _, toxic in marks) and (found[300], found[301]) == (1, 0)


def test_rare_terms_of_many_toxic_rows(spark):
    """A term in 99 of 100,000 toxic rows and in no clean row is an entry; one that clean rows hold as often is none."""
    rows = spark.range(200_000).selectExpr(
        "CASE WHEN id < 99 THEN 'zorgblat here' WHEN id % 1000 = 500 THEN 'plainword here'"
        " ELSE concat('filler', id % 50) END AS text",
        "CAST(id < 100000 AS INT) AS label",
    )
    lexicon = toxicity.lexicon_of(rows, 100_000, 100_000)
    assert [term for term in lexicon if "zorgblat$".startswith(term)] == ["zorgblat$"]
    assert not any(term.startswith("plai") for term in lexicon)


def test_odd_rows_and_labels(spark, tmp_path):
    docs = stored(spark, tmp_path, ODD)
    given = labels(spark, [(1, 1, 1), (1, 1, 0), (5, 0, 0), (2, None, None), (None, 1, 1), (99, 0, 1), (6, 1, 7)])
    rows = toxicity.scores(docs, given).collect()
    assert len(rows) == len(ODD) and all(0 <= row.score <= 1 for row in rows)


def test_no_labels_and_no_documents(spark, tmp_path):
    docs = stored(spark, tmp_path, ODD)
    assert all(row.predicted == 0 for row in toxicity.scores(docs, labels(spark, [])).collect())
    assert toxicity.scores(stored(spark, tmp_path, [], name="none"), labels(spark, [(1, 1, 1)])).collect() == []
