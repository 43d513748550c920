import collections
import math
import random
import re

from helpers import EXTRA, WORD, awkward, frame, words
from ledgerline.llm import op7_quality_rules as op


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    n, repeat = len(w), len(covered)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat, n < 20 or 100 * repeat > 30 * n


def histograms(text):
    text = text or ""
    w = WORD.findall(text)
    chars = len(text)
    upper, letters = sum(c.isupper() for c in text), sum(c.isalpha() for c in text)
    digits, symbols, space = sum(c.isdigit() for c in text), len(re.findall(r"[#*$%&|<>]", text)), chars - sum(map(len, w))
    classes = [upper, letters - upper, digits, space, symbols, chars - letters - digits - space - symbols]
    common = [sum(x in op.COMMON_WORDS[lang] for x in w) for lang in op.Rules().languages]
    union = set().union(*op.COMMON_WORDS.values())
    return classes, [*common, len(w) - sum(x in union for x in w)], chars, len(w)


def divergence(counts, total, q):
    out = 0.0
    for c, b in zip(counts, q):
        a = c / max(total, 1)
        m = (a + b) / 2
        out += (a * math.log2(a / m) if a > 0 else 0) / 2 + (b * math.log2(b / m) if b > 0 else 0) / 2
    return math.sqrt(max(out, 0))


def corpus():
    rng = random.Random(3)
    rows = [(*r, "en") for r in awkward(rng)]
    common = op.COMMON_WORDS["en"]
    for i in range(60):
        text = ". ".join(" ".join(rng.choice(common) if rng.random() < 0.4 else f"Word{rng.choice('abcdef')}ing" for _ in range(12)) for _ in range(rng.randrange(1, 9)))
        kind = i % 6
        if kind == 1:
            text = text.replace(" ", "&&& ")
        if kind == 2:
            text = text.upper()
        if kind == 3:
            text = text + "\n" + text + "\n" + text
        rows.append((100 + i, text, "en" if i % 2 else "de" if i % 4 else None))
    return rows


def test_against_plain_python(spark):
    rows = corpus()
    docs = frame(spark, [r for r in rows])
    got = op.annotate(docs).collect()
    assert len(got) == len(rows)
    rules = op.Rules()
    refs = {}
    for lang in rules.languages:
        own = [histograms(r[1]) for r in rows if r[2] == lang]
        sums = [[sum(h[k][i] for h in own) for i in range(len(own[0][k]))] for k in (0, 1)] if own else None
        if sums and any(sums[0]) and any(sums[1]):
            refs[lang] = [[x / sum(s) for x in s] for s in sums]
    texts = collections.defaultdict(list)
    for r in rows:
        texts[r[0]].append(r[1])
    for r in got:
        t = texts[r["doc_id"]][0]
        b = base(t)
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == b
        classes, common, chars, n = histograms(t)
        fits = [
            (chars < rules.min_chars_for_classes or divergence(classes, chars, q[0]) <= rules.max_class_distance)
            and (n < rules.min_words_for_common or divergence(common, n, q[1]) <= rules.max_common_distance)
            for q in refs.values()
        ]
        assert r["kept"] == (not b[5] and any(fits)), r["doc_id"]


def test_keep_returns_the_rows_as_they_were(spark):
    rows = corpus()
    docs = frame(spark, rows)
    verdict = {r["doc_id"]: r["kept"] for r in op.annotate(docs).collect()}
    out = op.keep(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows if verdict[r[0]])
    assert all(r[c] == f"{c}-{r['doc_id']}" for r in got for c in EXTRA)


def test_no_python_in_the_plan_and_empty_table(spark):
    docs = frame(spark, [])
    out = op.annotate(docs)
    assert out.count() == 0
    plan = op.annotate(frame(spark, corpus()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_short_texts_are_guarded(spark):
    rows = [(i, words(random.Random(i), 40), "en") for i in range(5)] + [(9, "&&& " * 24, "en")]
    got = {r["doc_id"]: r for r in op.annotate(frame(spark, rows)).collect()}
    assert not got[9]["kept"]


def test_texts_without_common_words_are_rejected(spark):
    rng = random.Random(5)
    common = op.COMMON_WORDS["en"]
    some = lambda share, i: " ".join(rng.choice(common) if rng.random() < share else f"w{rng.randrange(10**6)}" for _ in range(80))
    rows = [(i, some(0.22, i), "en") for i in range(40)] + [(100 + i, some(0.0, i), None) for i in range(5)]
    got = {r["doc_id"]: r for r in op.annotate(frame(spark, rows)).collect()}
    assert all(got[i]["kept"] for i in range(40))
    assert not any(got[i]["kept"] or got[i]["base_failed"] for i in range(100, 105))
    assert all(got[i]["class_distance"] <= op.Rules().max_class_distance for i in got)


def test_languages_without_listed_words_are_held_against_themselves(spark):
    rng = random.Random(8)
    common = op.COMMON_WORDS["en"]
    english = [(i, " ".join(rng.choice(common) if rng.random() < 0.4 else f"word{chr(97 + rng.randrange(26))}" for _ in range(120)), "en") for i in range(5)]
    finnish = [(10 + i, " ".join(rng.choice(["talossa", "vesi", "kirja", "mutta", "joka", "sitten", "yksi"]) for _ in range(119)) + f" loppu{i}", "fi") for i in range(5)]
    scripts = [(20 + i, "".join(chr(0x4E00 + rng.randrange(500)) + ("、 " if j % 9 == 8 else "") for j in range(600)), "zh") for i in range(5)]
    noise = [(30, " ".join("#$%&*|<>" for _ in range(60)), "fi"), (31, " ".join(rng.choice(["talossa", "vesi", "kirja"]) for _ in range(100)), None)]
    loose = op.Rules(max_repeat_percent=100)
    got = {r["doc_id"]: r["kept"] for r in op.annotate(frame(spark, english + finnish + scripts + noise), loose).collect()}
    assert [i for i, kept in got.items() if not kept] == [30, 31]
    only = {r["doc_id"]: r["kept"] for r in op.annotate(frame(spark, finnish + noise), loose).collect()}
    assert all(only[i] for i in range(10, 15)) and not only[30] and only[31]
