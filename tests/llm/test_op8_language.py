import collections
import random

from helpers import EXTRA, awkward, frame
from ledgerline.llm import op8_language_id as op

SYLLABLES = {"en": "the ing and ion ent her for tha".split(), "de": "sch ein ung der ich ber äu zu".split(), "fr": "é eau ou que eux la tre ai".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))).capitalize() for _ in range(n)) + "."


def grams(t):
    """Counts of the 1- to 3-grams by plain Python."""
    out = collections.Counter()
    cls = op.letter_classes()
    codes = [int(cls[ord(c)]) for c in t or ""]
    if not any(codes):
        return out
    seq = []
    for c in codes:
        if c or (seq and seq[-1]):
            seq.append(c)
    if seq[0]:
        seq = [0, *seq]
    if seq[-1]:
        seq.append(0)
    for i in range(len(seq)):
        if seq[i]:
            out[seq[i]] += 1
        if i + 1 < len(seq):
            out[op.LETTERS + seq[i] * op.LETTERS + seq[i + 1]] += 1
        if i + 2 < len(seq) and seq[i + 1]:
            out[op.LETTERS + op.LETTERS**2 + (seq[i] * op.LETTERS + seq[i + 1]) * op.LETTERS + seq[i + 2]] += 1
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    return [(1000 + i, text(rng, lang, rng.randrange(3, 80)), lang) for i in range(n) for lang in [rng.choice(sorted(SYLLABLES))]]


def test_counts_profiles_and_predictions_against_plain_python(spark):
    train = corpus(1, 60) + [(1, None, "en"), (2, "No language", None), (3, "", "de"), (4, "123 --", "fr")]
    docs = frame(spark, train)
    counts = collections.defaultdict(collections.Counter)
    for _, t, lang in train:
        if lang and t is not None:
            counts[lang].update(grams(t))
    got = {(r["lang"], r["code"]): r["n"] for r in op.count_ngrams(docs, "text", "lang").collect()}
    assert got == {(lang, code): n for lang, own in counts.items() for code, n in own.items()}

    profiles = op.fit(docs, length=50, vocabulary=80)
    ranked = {lang: [c for c, _ in sorted(own.items(), key=lambda x: (-x[1], x[0]))[:80]] for lang, own in counts.items()}
    union = set().union(*ranked.values())
    test = corpus(2, 40) + [(1, None), (2, "12, 34"), (3, "the"), (4, "Überstzung")]
    out = {r["doc_id"]: r for r in op.predict(frame(spark, test), profiles).collect()}
    for row in test:
        own = collections.Counter({c: n for c, n in grams(row[1]).items() if c in union})
        best = [c for c, _ in sorted(own.items(), key=lambda x: (-x[1], x[0]))[:50]]
        if not grams(row[1]):
            assert (out[row[0]]["lang_pred"], out[row[0]]["score"]) == ("und", 0.0)
            continue
        apart = {}
        for lang in sorted(ranked):
            place = {c: i for i, c in enumerate(ranked[lang][:50])}
            apart[lang] = sum(abs(place[c] - i) if c in place else 50 for i, c in enumerate(best)) / (max(len(best), 1) * 50) if best else 1.0
        nearest = min(apart, key=lambda lang: (apart[lang], lang))
        assert out[row[0]]["lang_pred"] == nearest
        assert abs(out[row[0]]["score"] - (1 - apart[nearest])) < 1e-9
    assert sum(out[r[0]]["lang_pred"] == r[2] for r in test[:40]) >= 39


def test_awkward_rows_and_nothing_learned(spark):
    profiles = op.fit(frame(spark, corpus(3, 30)))
    got = op.predict(frame(spark, awkward()), profiles).collect()
    assert len(got) == len(awkward())
    assert {r["doc_id"]: r["lang_pred"] for r in got}[2] == "und"
    assert all(r[c] == f"{c}-{r['doc_id']}" for r in got for c in EXTRA if c != "score")
    assert op.predict(frame(spark, []), profiles).count() == 0
    none = op.fit(frame(spark, []))
    assert {(r["lang_pred"], r["score"]) for r in op.predict(frame(spark, awkward()), none).collect()} == {("und", 0.0)}
