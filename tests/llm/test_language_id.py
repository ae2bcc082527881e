import math
import random
from collections import Counter, defaultdict

import numpy as np

from careledger.llm import language_id as lid

SYLLABLES = {"en": ["the", "ing", "on", "wh", "ly"], "de": ["sch", "ein", "keit", "ü", "der"], "fr": ["eau", "ç", "oi", "é", "que"]}


def text(rng, lang, n=30):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows(n=150, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        out.append((i, text(rng, lang), lang if rng.random() < 0.9 else rng.choice(list(SYLLABLES)), f"h{i % 7}.example.{'com' if i % 2 else 'de'}"))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "id long, text string, declared string, host string").repartition(4)


def trigrams(text):
    """Every three bytes of the letters in lower case, with one blank between words and at the ends."""
    raw = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in (text or "").lower().encode())
    raw = b" ".join(raw.split())
    return [(b" " + raw + b" ")[k:k + 3] for k in range(len(raw))] if raw else []


def brute(data, least=0.5, strength=20.0, temper=0.33, smooth=0.5):
    """The same posterior in plain Python."""
    said = sorted({d.lower() for _, _, d, _ in data if d} - {"und"})
    n = len(said) + 1
    grams = [trigrams(t) for _, t, _, _ in data]
    counts = [Counter() for _ in said]
    for (_, _, d, _), g in zip(data, grams):
        if d and d.lower() in said:
            counts[said.index(d.lower())].update(g)
    kinds = max(len(set().union(*counts)), lid.LEAST_KINDS)
    sizes = [sum(c.values()) + smooth * kinds for c in counts]

    def likelihood(g):
        return np.array([sum(math.log((c[x] + smooth) / s) for x in g) for c, s in zip(counts, sizes)] + [-math.log(kinds) * len(g)])

    def softmax(x):
        e = np.exp(np.array(x) - max(x))
        return e / e.sum()

    ll = [likelihood(g) * temper for g in grams]
    p = [softmax(x) for x in ll]
    hosts, suffixes, table = defaultdict(lambda: np.zeros(n)), defaultdict(lambda: np.zeros(n)), np.full((n, n), 0.5)
    suffix = lambda h: (h or "").rsplit(".", 1)[-1] if "." in (h or "") else ""
    for (_, _, d, h), q, g in zip(data, p, grams):
        hosts[h or ""] += q
        suffixes[suffix(h)] += q
        if len(g):
            table[:, said.index(d.lower()) if d and d.lower() in said else n - 1] += q
    whole = sum(hosts.values())
    corpus = (whole + 1) / (whole.sum() + n)
    table = np.log(table / table.sum(1, keepdims=True))
    out = {}
    for (i, _, d, h), q, x, g in zip(data, p, ll, grams):
        t = suffixes[suffix(h)]
        prior = (t + strength * corpus) / (t.sum() + strength)
        s = hosts[h or ""]
        prior = (np.maximum(s - q, 0) + strength * prior) / (max(s.sum() - 1, 0) + strength)
        post = softmax(x + np.log(prior) + table[:, said.index(d.lower()) if d and d.lower() in said else n - 1])
        best = int(post.argmax())
        lang, prob = ([*said, "und"][best], float(post.max())) if len(g) else ("und", 1.0)
        out[i] = (lang, prob, lang != "und" and prob >= least)
    return out


def test_matches_brute_force_and_finds_languages(spark):
    data = rows()
    want = brute(data)
    got = {r.id: r for r in lid.identify(frame(spark, data)).collect()}
    assert len(got) == len(data)
    for i, (lang, prob, kept) in want.items():
        assert (got[i].lang, got[i].kept) == (lang, kept) and abs(got[i].prob - prob) < 1e-9
    rng = random.Random(1)
    truth = []
    for i in range(150):
        truth.append(rng.choice(list(SYLLABLES)))
        text(rng, truth[-1])
        if rng.random() >= 0.9:
            rng.choice(list(SYLLABLES))
    assert np.mean([got[i].lang == t for i, t in enumerate(truth)]) > 0.97


def test_priors_decide_where_text_is_silent(spark):
    rng = random.Random(2)
    data = [(i, text(rng, "fr"), "fr", "a.fr") for i in range(60)] + [(100 + i, text(rng, "en"), "en", "b.com") for i in range(60)]
    data += [(900, "zq", None, "a.fr"), (901, "zq", None, "b.com"), (902, "zq", "fr", "c.org")]
    got = {r.id: r.lang for r in lid.identify(frame(spark, data)).collect()}
    assert (got[900], got[901], got[902]) == ("fr", "en", "fr")


def test_edge_rows(spark):
    data = [*rows(60), (1000, None, "en", "x"), (1001, "", None, None), (1002, "123 .. --", "de", "x"), (None, "the whing only", "en", "x"),
            (1003, "the whing only", None, None), (1003, "the whing only", None, None), (1004, "sch " * 50_000, "de", "x")]
    got = lid.identify(frame(spark, data)).collect()
    assert len(got) == len(data)
    judged = defaultdict(list)
    for r in got:
        judged[r.id].append((r.lang, r.kept))
    assert judged[1000] == judged[1001] == judged[1002] == [("und", False)]
    assert judged[1003][0] == judged[1003][1] and judged[1004][0][0] == "de"
    assert lid.identify(frame(spark, data).limit(0)).count() == 0
    nobody = [(i, t, None, h) for i, t, _, h in rows(5)]
    assert {(r.lang, r.kept) for r in lid.identify(frame(spark, nobody)).collect()} == {("und", False)}


def test_pages(spark):
    rng = random.Random(3)
    pages = [(i, f"https://u@{lang}{i % 3}.example.{lang}:80/x", f'<html class=a lang="{lang}"><script>var the = 1</script><p>{text(rng, lang)}</p>')
             for i, lang in enumerate(["fr", "en"] * 30)] + [(99, None, None), (98, "not a url", "<p>the only whing</p>")]
    df = lid.page_rows(spark.createDataFrame(pages, "page_id long, url string, html string"))
    row = df.where("id = 0").first()
    assert (row.declared, row.host) == ("fr", "fr0.example.fr") and "var" not in row.text
    got = {r.id: r for r in lid.identify(df).collect()}
    assert all(got[i].lang == ("fr" if i % 2 == 0 else "en") for i in range(60)) and not got[99].kept and got[98].lang == "en"


def test_keep_identified(make_docs):
    rng = random.Random(4)
    docs = make_docs([(i, text(rng, "en"), "en", "s") for i in range(30)] + [(100, "", "en", "s"), (101, "!!", "en", "s"), (None, text(rng, "en"), "en", "s")])
    kept = lid.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([*range(30), None], key=str)


def test_keep_identified_tells_rows_of_one_id_apart(make_docs):
    rng = random.Random(6)
    fine = [text(rng, "en") for _ in range(34)]
    docs = make_docs([*[(i, t, "en", "s") for i, t in enumerate(fine[:30])], (None, fine[30], "en", "s"), (None, "!!", "en", "s"),
                      (None, None, "en", "s"), (50, fine[31], "en", "s"), (50, "", "en", "s"), (51, fine[32], "en", "s"),
                      (51, fine[32], "en", "s")])
    kept = [(r.doc_id, r.text) for r in lid.keep_identified(docs).collect()]
    assert sorted(kept, key=str) == sorted([*enumerate(fine[:30]), (None, fine[30]), (50, fine[31]), (51, fine[32]), (51, fine[32])], key=str)


def test_sums_as_rows_are_those_as_columns(spark, monkeypatch):
    data = rows(60)
    monkeypatch.setattr(lid, "MOST_COLUMNS", 1)
    monkeypatch.setattr(lid, "HELD", 100)
    want = brute(data)
    for r in lid.identify(frame(spark, data)).collect():
        assert (r.lang, r.kept) == (want[r.id][0], want[r.id][2]) and abs(r.prob - want[r.id][1]) < 1e-9


def test_trigrams_are_told_apart():
    """No two trigrams share a count, also those of non-Latin scripts."""
    text = "日本語 العربية ไทย русский język the"
    assert sorted(lid._grams(text).tolist()) == sorted(int.from_bytes(g, "big") for g in trigrams(text))
    assert len(set(lid._grams(text).tolist())) == len(set(trigrams(text)))


def test_more_than_two_hundred_languages(spark):
    """Each of 230 declared values has a model, also those that few rows declare."""
    rng = random.Random(9)
    own = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(4)] for _ in range(230)]
    data = []
    for k, syllables in enumerate(own):
        for _ in range(3 if k < 200 else 2):
            data.append((len(data), " ".join("".join(rng.choice(syllables) for _ in range(2)) for _ in range(60)), f"x{k:03}", f"h{k % 5}.org"))
    want = brute(data)
    got = {r.id: r for r in lid.identify(frame(spark, data)).collect()}
    assert all((got[i].lang, got[i].kept) == (w[0], w[2]) and abs(got[i].prob - w[1]) < 1e-9 for i, w in want.items())
    assert all(got[i].lang == d for i, _, d, _ in data)
