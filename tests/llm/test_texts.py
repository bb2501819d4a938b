import random
from pathlib import Path

import numpy as np
import pytest

from tessera.llm import abuse, encode, leak, pair_quality
from tessera.llm.text import words

TOKENIZER = encode.DEFAULT_TOKENIZER


@pytest.mark.skipif(not Path(TOKENIZER).exists(), reason="no tokenizer files here")
def test_encoding_equals_the_tokenizer(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(TOKENIZER)
    tok.encode_special_tokens = True
    texts = [None, "", " ", "\n\n  x", "it's <|endoftext|> here", "naïve  Ünïcödé 🙂🙃 ①", "a b c\x00\x85", "日本語 текст", "x" * 50_000, "word " * 30_000, "it's"]
    rows = [(i, t, [1], "c") for i, t in enumerate(texts)] + [(None, "null id", [1], "c"), (1, "again", [1], "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids array<int>, block string")
    got = [(r.doc_id, r.ids) for r in encode.encode_corpus(df).collect()]
    want = [(i, tok.encode(t or "", add_special_tokens=False).ids) for i, t, _, _ in rows]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(got, key=key) == sorted(want, key=key)
    back = encode.decode_corpus(encode.encode_corpus(df.where("doc_id <> 1"))).collect()
    assert {r.doc_id: r.text for r in back} == {i: t or "" for i, t, _, _ in rows if i not in (None, 1)}
    assert encode.encode_corpus(df.limit(0)).count() == 0


def test_automaton_against_brute_force():
    rng = random.Random(8)
    for least in (2, 3, 5):
        items = [[rng.choice("abc") for _ in range(rng.randint(0, 12))] for _ in range(8)]
        auto = leak.SuffixAutomaton(least)
        for s in items:
            auto.add(s)
        auto.finish()
        for _ in range(60):
            text = [rng.choice("abcd") for _ in range(rng.randint(0, 25))]
            covered = {}
            for k, s in enumerate(items):
                grams = {tuple(s[i : i + least]) for i in range(len(s) - least + 1)}
                for i in range(len(text) - least + 1):
                    if tuple(text[i : i + least]) in grams:
                        covered.setdefault(k, set()).update(range(i, i + least))
            got = {k: {x for a, b in spans for x in range(a, b)} for k, spans in auto.runs(text).items()}
            assert got == covered


def test_leaks_spans_and_removal(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my nu xi"
    docs = [
        (1, f"Before. {item.upper().replace(' ', ' -- ')} after!", "x"),
        (2, " ".join(item.split()[:12]), "x"),
        (3, None, "x"),
        (4, "", "x"),
        (5, "İ " + item.replace(" ", "\n") + " " + "filler " * 20_000, "x"),
        (1, item, "again"),
    ]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string")
    items = spark.createDataFrame([(7, item, "s"), (8, "x " + item[6:], "s"), (9, "short", "s"), (10, None, "s")], "item_id bigint, text string, suite string")
    for most in (leak.MAX_WORDS, 14):
        got = leak.find_leaks(df.drop("item_id"), items, max_words=most)
        assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(1, 7), (1, 7), (1, 8), (1, 8), (5, 7), (5, 8)]
    spans = {r.longest for r in got.where("item_id = 7").collect()}
    assert spans == {14}
    one = df.where("doc_id = 1 AND item_id = 'x'").drop("item_id")
    clean = leak.remove_leaks(one, leak.find_leaks(one, items.where("item_id = 7"))).collect()
    assert [r.clean_text for r in clean] == ["Before.  after!"]
    report = {r.item_id: (r.n_documents, r.longest) for r in leak.item_report(got).collect()}
    assert report == {7: (3, 14), 8: (3, 13)}
    assert leak.find_leaks(df.drop("item_id").limit(0), items).count() == 0
    assert leak.find_leaks(df.drop("item_id"), items.limit(0)).count() == 0


EN = "the cat and the dog are in the house with the other animals and they have been there for a long time because it is warm "
DE = "die Katze und der Hund sind in dem Haus mit den anderen Tieren und sie sind dort schon lange weil es warm ist und nicht kalt "
ES = "el gato y el perro están en la casa con los otros animales y llevan allí mucho tiempo porque hace calor y no hace frío "


def test_pair_defects(spark):
    docs = spark.createDataFrame([(t * 3, lang) for t, lang in ((EN, "en"), (DE, "de"), (ES, "ES")) for _ in range(4)] + [(None, "en"), ("x", None), ("y", "und")], "text string, lang string")
    prompt = "Explain to me why the dog and the cat are in the house and not in the garden, please."
    sound = "They are in the house because it is warm there and they have been there for a long time."
    german = "Die Katze und der Hund sind in dem Haus weil es dort warm ist und nicht kalt."
    cases = [
        (None, "empty"), ("", "empty"), (" ​﻿", "empty"), ("—", "empty"), ("N/A", "empty"), ("No answer was provided.", "empty"), ("[Antwort fehlt]", "empty"), ("No text is missing in the house.", None), ("(no answer)", "empty"), ("None", "empty"), ("```\n```", "empty"),
        (sound, None), ("Yes", None), ("42.5 metres", None), ("Napoleon", None), ("- red house\n- blue house", None), ("```python\nprint(1)\n```", None), ('{"a": [1, 2]}', None),
        (f'You asked: "{prompt}". {sound}', None), ("I'm sorry for the wait. " + sound, None),
        (prompt, "copied"), (prompt.upper(), "copied"), (f"Question: {prompt}", "copied"), (prompt[:60], "copied"), (f"{prompt} {prompt}", "copied"),
        ("I'm sorry, but I can't help with that.", "refusal"), ("I’m unable to provide information on this. Take care.", "refusal"), ("Lo siento, pero no puedo ayudar con eso.", "refusal"),
        ("Es tut mir leid, aber dabei kann ich nicht helfen.", "refusal"), ("Je préfère ne pas répondre.", "refusal"), ("I'm sorry, but I can't help with that. " + "Thank you for asking. " * 40, "refusal"),
        ("They are in the house because it is warm there and they have,", "truncated"), ("They are in the house because the other …", "truncated"),
        ("They are in the house.\n```python\ndef f(x):\n    retu", "truncated"), ('{"a": [1, 2', "truncated"),
        (german, "language"),
    ]
    rows = [(i, prompt, a, "clash") for i, (a, _) in enumerate(cases)] + [(900, prompt + " Answer in German.", german, "c"), (901, None, german, "c"), (902, None, None, "c"), (903, prompt, sound * 3000, "c")]
    rows += [(1000 + i, prompt, sound, "c") for i in range(200)]
    df = spark.createDataFrame(rows, "row_index bigint, prompt string, response string, defect string")
    got = {r.row_index: r.defect for r in pair_quality.pair_defects(spark, {"t": (df, "row_index", "prompt", ["response"])}, docs).collect()}
    want = {i: d for i, (_, d) in enumerate(cases) if d} | {902: "empty"}
    assert got == want
    none = pair_quality.pair_defects(spark, {"t": (df.limit(0), "row_index", "prompt", ["response"])}, docs.limit(0))
    assert none.count() == 0


def test_answers_cut_inside_a_word(spark):
    """Tails that occur only as the ends of cut texts don't vouch for themselves, nor do copies of a
    text or other texts cut there; habitual ends without a mark stay sound."""
    names = [a + b for a in "BDKLMNPRST" for b in ("ano", "eka", "ilu", "oma", "uri")]
    sound = [f"The harbor of {x} holds spare parts and the growers of {x} cannot wait, they say." for x in names * 8]
    cut = ["Without a prompt the growers of Bano cannot gro", "The harbor of Deka holds spa", "The growers wait near the harb", "Some growers of Kilu wait near the harb", "The growers wait near the harb", "They wait near every harb"]
    habit = [f"The growers of {x} wait near the sea" for x in names] + [f"Near the sea wait the growers of {x}" for x in names]
    for texts, want in ((sound + cut, set(range(len(sound), len(sound) + len(cut)))), (habit * 2 + cut[:2], {4 * len(names), 4 * len(names) + 1})):
        df = spark.createDataFrame([(i, "Why?", a) for i, a in enumerate(texts)], "row_index bigint, prompt string, response string")
        docs = spark.createDataFrame([], "text string, lang string")
        got = pair_quality.pair_defects(spark, {"t": (df, "row_index", "prompt", ["response"])}, docs).collect()
        assert {r.row_index for r in got if r.defect == "truncated"} == want


def test_language_model_on_held_out_texts(spark):
    docs = spark.createDataFrame([(t * 3, lang) for t, lang in ((EN, "en"), (DE, "de"), (ES, "es")) for _ in range(4)], "text string, lang string")
    langs, table = pair_quality.language_model(docs)
    assert langs == ["de", "en", "es"]
    for text, lang in (("there is a dog with them in the warm house", "en"), ("der Hund ist nicht mit der Katze in dem Haus", "de"), ("el perro no está con los otros en la casa", "es")):
        assert pair_quality.language_of(text, langs, table)[0] == lang
    assert pair_quality.language_of("", langs, table)[0] is None


def test_rare_languages_have_a_class(spark):
    docs = [(t, lang) for t, lang in ((EN, "en"), (DE, "de")) for _ in range(2500)] + [(ES * 3, "es")] * 3 + [("hola", "xx")]
    langs, table = pair_quality.language_model(spark.createDataFrame(docs, "text string, lang string"))
    assert langs == ["de", "en", "es"]
    assert pair_quality.language_of("el perro no está con los otros en la casa", langs, table)[0] == "es"


def test_spelling_is_undone():
    same = ["idiot", "1d1ot", "IDIOOOT", "i_d_i_o_t", "i-d-i-o-t", "id​iot", "іdiоt", "ｉｄｉｏｔ", "ídiot"]
    assert {tuple(abuse.plain_tokens(s)) for s in same} == {("idiot",)}
    s = abuse.Sentences()
    assert np.array_equal(s.tokens(["you i d i o t now"])[0], s.tokens(["you idiot now"])[0])
    assert abuse.plain_tokens("i****t") == ["*", "i****t"] and abuse.plain_tokens("1999") == ["1999"]


def labelled(rng, n):
    calm = ["the report is long", "we moved the table to the other room", "idiot proof design is praised", "the clinic counts cases", "numbers rise in spring"]
    bad = {"abusive": "you are a stupid idiot and everyone knows it", "hateful": "all the zorblans are filthy animals", "sexual": "she begged him to undress her slowly"}
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(calm) for _ in range(rng.randint(2, 6))]
        kinds = [c for c in bad if rng.random() < 0.15]
        text += [bad[c] for c in kinds]
        rng.shuffle(text)
        docs.append((i, ". ".join(text) + "." if text else None, "s%d" % (i % 2)))
        labels += [(i, c) for c in kinds or ["none"]]
        if rng.random() < 0.02:
            labels.append((i, rng.choice(list(bad))))
    return docs, labels


def test_abuse_on_held_out_documents(spark):
    docs, labels = labelled(random.Random(9), 900)
    d = spark.createDataFrame([*docs, (5000, None, None), (5001, " ", "s0")], "doc_id bigint, text string, source string")
    lab = spark.createDataFrame([*(x for x in labels if x[0] < 600), (7, None), (99999, "abusive")], "doc_id bigint, category string")
    weights, bias = abuse.fit_labels(d, lab)
    assert 0 < (weights != 0).any(axis=1).sum() < 5000
    scores = abuse.score_documents(d, weights, bias, keep=("source",))
    assert scores.count() == 902
    got = {(r.doc_id, r.category) for r in abuse.found(scores.where("doc_id >= 600")).collect()}
    truth = {(i, c) for i, c in labels if i >= 600 and c != "none" and c in ("abusive", "hateful", "sexual")}
    exact = {(i, c) for i, c in truth if {"abusive": "stupid", "hateful": "zorblans", "sexual": "undress"}[c] in docs[i][1]}
    assert len(got & exact) >= 0.95 * len(exact) and len(got - exact) <= 0.02 * len(exact)
    rates = {r.source: r.n_documents for r in abuse.rates(scores, "source").collect()}
    assert rates == {"s0": 451, "s1": 450, "(none)": 1}


def test_abuse_without_labels(spark):
    d = spark.createDataFrame([(1, "text here", "s")], "doc_id bigint, text string, source string")
    weights, bias = abuse.fit_labels(d, spark.createDataFrame([], "doc_id bigint, category string"))
    assert abuse.found(abuse.score_documents(d, weights, bias)).count() == 0
    assert abuse.score_documents(d.limit(0), weights, bias).count() == 0


def test_words():
    assert words("A-b_c ÄÖ 1²") == ["a", "b", "c", "äö", "1²"] and words(None) == []
