from __future__ import annotations

import numpy as np

from playmart.llm import langid

WORDS = {"aa": "bana lopa miru tanako sela".split(), "zz": "krzt vlsk grmpf strv prsk".split()}


def texts(n, seed=1):
    rng = np.random.default_rng(seed)
    return [(" ".join(rng.choice(WORDS[k], 30)), k) for k in ("aa", "zz") for _ in range(n)]


def test_held_out_texts_are_told_apart(docs):
    model = langid.train(texts(40))
    got = langid.predict(docs([(i, t, k) for i, (t, k) in enumerate(texts(20, seed=9))]), model).select("row.lang", "lang_pred", "score", "accepted").collect()
    assert all(r.lang == r.lang_pred and 0.5 <= r.score <= 1 and r.accepted for r in got)


def test_subwords_against_plain_ones():
    s = langid.Settings(buckets=1 << 20, grams=(2, 3, 4))

    def plain(text):
        marked = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
        out = []
        for n in s.grams:
            for i in range(len(marked) - n + 1):
                g = marked[i : i + n]
                inner = g[1:-1] if n > 2 else ""
                if " " not in inner and g.strip():
                    out.append(g)
        return out

    for text in ("ab", "a b", "Ab1c--d", "é", "", "12", "abc def"):
        got = np.concatenate([*langid.subwords(text, s), np.zeros(0, np.int64)])
        want = plain(text)
        assert len(got) == len(want) and len(set(got.tolist())) == len(set(want))


def test_blocks_give_what_one_pass_gives(monkeypatch):
    s, text = langid.Settings(), "Lorem ipsum 12 dolor, sit amet " * 20
    whole = np.sort(np.concatenate([*langid.subwords(text, s)]))
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert (np.sort(np.concatenate([*langid.subwords(text, s)])) == whole).all()


def test_odd_documents(odd, nothing, docs):
    model = langid.train(texts(10))
    got = {r.doc_id: r for r in langid.predict(odd, model).select("row.doc_id", "lang_pred", "score", "accepted").collect()}
    for i in (1, 2, 3):
        assert (got[i].lang_pred, got[i].score, got[i].accepted) == ("und", 0.0, False)
    assert got[7].lang_pred in ("aa", "zz")
    assert langid.predict(nothing, model).count() == 0
    unlearned = langid.predict(docs([(1, "text")]), langid.train([])).first()
    assert (unlearned.lang_pred, unlearned.accepted) == ("und", False)


def test_rejected_documents_go_and_columns_stay(docs):
    rows = [(i, t, k) for i, (t, k) in enumerate(texts(30))] + [(900, "12345 ...", None), (901, None, None)]
    frame = docs(rows)
    kept = langid.keep_identified(frame)
    assert kept.columns == frame.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {900, 901} and len(ids) >= 59


def test_training_texts_stay_out_of_the_driver(docs, monkeypatch):
    given = docs([(i, f"{'the cat sat' if i % 2 else 'le chat dort'} {i}", "en" if i % 2 else "fr") for i in range(40)])
    rows = sorted((r.text, r.lang) for r in given.collect())
    plain = langid.train(rows)

    def here(*_):
        raise AssertionError("a text is read in the driver")

    monkeypatch.setattr(langid, "_bag", here)
    model = langid.fit(given)
    assert model.labels == plain.labels == ("en", "fr") and np.allclose(model.table, plain.table)
    assert langid.fit(given.filter("doc_id < 0")).labels == ()
