import random

from tidemark.llm import language as la

STEMS = {"aa": ["theon", "ander", "ing", "with", "ofthe"], "bb": ["que", "los", "cion", "para", "ñado"], "cc": ["und", "schein", "keit", "ä", "ver"]}


def text(rng, lang, n=40):
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_held_out_accuracy(docs):
    rng = random.Random(7)
    rows = [(i, text(rng, lang), lang) for i, lang in enumerate(rng.choice(list(STEMS)) for _ in range(240))]
    d = docs(rows)
    model = la.learn(d.where("doc_id < 120"))
    assert [lang for lang, _ in model] == sorted(STEMS)
    got = {r.doc_id: r for r in la.identify(d, model).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang in rows if i >= 120) >= 118
    assert all(0 <= r.score <= 1 for r in got.values())


def test_a_foreign_passage_does_not_decide(docs):
    rng = random.Random(8)
    passage = text(rng, "aa", 30)
    rows = [(i, text(rng, lang, 80), lang) for i, lang in enumerate(["aa", "bb"] * 20)]
    rows.append((100, text(rng, "bb", 80) + " " + passage, "bb"))  # the bb dictionary knows the passage
    model = la.learn(docs(rows))
    (r,) = la.identify(docs([(1, text(rng, "aa", 120) + " " + passage)]), model).collect()
    assert r.lang_pred == "aa"


def test_edges(docs, edge_docs):
    model = la.learn(docs([(1, "theon ander ing", "aa"), (2, None, "bb"), (3, "que los", None), (4, "123", "dd")]))
    assert [lang for lang, _ in model] == ["aa"]
    rows = la.identify(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {0, 1, 2} and all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert all(r.lang_pred == "und" for r in la.identify(edge_docs, []).collect())
    assert la.identify(docs([]), model).collect() == []


def test_ties_are_rejected_and_go_to_the_first_name(docs):
    model = la.learn(docs([(1, "same words here", "xx"), (2, "same words here", "bb")]))
    (r,) = la.identify(docs([(1, "other things entirely")]), model).collect()
    assert (r.lang_pred, r.margin, r.rejected, r.score) == ("bb", 0.0, True, 0.5)


def test_number_characters_are_no_letters(docs):
    model = la.learn(docs([(1, "theon ander ing", "aa")]))
    texts = ["½", "²³", "Ⅷ", "٣", "_", "漢", "ª"]
    got = {r.doc_id: r.lang_pred for r in la.identify(docs(list(enumerate(texts))), model).collect()}
    assert [got[i] for i in range(7)] == ["und"] * 5 + ["aa"] * 2


def test_whole_texts_are_learnt_up_to_a_budget(docs, monkeypatch):
    monkeypatch.setattr(la, "SAMPLE_CHARS", 400)
    monkeypatch.setattr(la, "SAMPLE_DOCS", 8)
    long = "x" * 300 + "tail"
    rows = [(1, long, "aa"), (1, long, "aa"), (2, "y" * 90, "aa"), (3, "z" * 5000 + "ending", "aa"), (4, "b" * 900 + "c" * 900, "bb")]
    model = dict(la.learn(docs(rows)))
    assert sorted(model["aa"].split(b"\n")) == [long.encode(), b"y" * 90]  # each once and whole, the third passed over
    assert len(model["bb"]) <= 400 + 8 and model["bb"].count(b"b") == model["bb"].count(b"c") > 0  # pieces over all of it


def test_one_language_may_hold_most_rows(docs):
    rows = [(i, f"theon ander {i}", "aa") for i in range(1500)] + [(5000, "que los", "bb"), (None, "para los", "bb")]
    model = dict(la.learn(docs(rows)))
    assert len(model["aa"].split(b"\n")) == la.SAMPLE_DOCS and len(model["bb"].split(b"\n")) == 2
