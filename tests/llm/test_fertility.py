import math
import random
import re
from collections import Counter

import pytest
import sentencepiece

from canvass.llm import fertility
from canvass.llm.fertility import quality_rules


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=fertility.VOCABULARY)


def base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i : i + 5])] > 1:
            hit |= set(range(i, i + 5))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit), len(w) < 10 or 100 * len(hit) > 20 * len(w)


def measures(text, model):
    ids = [i for w in re.findall(r"[^\x20\x09-\x0D]+", text or "") for i in model.encode(w)]
    n, chars = max(len(ids), 1), base(text)[1]
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(ids).values())
    return chars / n, sum(map(model.is_byte, ids)) / n, entropy


def test_columns(documents, model, monkeypatch):
    monkeypatch.setattr(fertility, "PIECES", 40)
    rnd = random.Random(1)
    rows = [(1, None), (2, ""), (3, "a\n\na\n \n a\na"), (4, "é🙂 # | <b> 中"), (None, "x " * 20), (5, "a b c d e f " * 2000), (5, "same"), (5, "same")]
    rows += [(10 + i, " ".join(rnd.choice(["one", "two", "thrée", "🙂"]) + rnd.choice(["", "\n", "%"]) for _ in range(rnd.randrange(50)))) for i in range(50)]
    df = documents(*rows).withColumnsRenamed({"source": "size", "n_chars": "n_words"})
    got = sorted((tuple(r) for r in quality_rules(df).collect()), key=repr)
    want = sorted(((i, *base(t), not base(t)[-1], *measures(t, model)) for i, t in rows), key=repr)
    assert [g[:7] for g in got] == [w[:7] for w in want]
    for g, w in zip(got, want):
        assert g[8:] == pytest.approx(w[8:])
    assert quality_rules(df.filter("false")).collect() == []


def test_bands(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice(["ther", "ing", "con", "ation"]) for _ in range(2))
    rows = [(i, " ".join(word() for _ in range(100)), "en") for i in range(300)]
    rows += [(1000, " ".join("%&*" + chr(0x1F600 + i % 50) for i in range(100)), "en"), (1001, " ".join("%&*🙂" + str(i) for i in range(100)), None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = {r.doc_id: r.kept for r in quality_rules(docs).collect()}
    assert not kept[1000]  # unlike its language
    assert not kept[1001]  # alone in its language and script: held to all texts
    assert sum(kept[i] for i in range(300)) == 300


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_given_documents(spark, model, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: tuple(r) for r in quality_rules(docs).collect()}
    for d in docs.collect():
        assert got[d.doc_id][1:7] == base(d.text)
        assert got[d.doc_id][8:] == pytest.approx(measures(d.text, model))
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    good = [got[r.doc_id][7] for r in labels if r.quality == 1 and not got[r.doc_id][6]]
    assert sum(good) >= 0.97 * len(good)


def test_marked_bad_texts_are_rejected(spark):
    """Of the labelled texts that pass the base rules: most bad ones go, nearly all good ones stay."""
    folder = "/root/testdata/sf0.1"
    got = quality_rules(spark.read.parquet(f"{folder}/documents.parquet")).filter("not base_failed")
    rows = got.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("quality", "kept").collect()
    bad, good = ([r.kept for r in rows if r.quality == q] for q in (0, 1))
    assert sum(bad) <= 0.25 * len(bad)
    assert sum(good) >= 0.985 * len(good)


SCRIPT = {"latin": r"[A-Za-z\u00aa\u00c0-\u02af\u1e00-\u1eff]", "greek": r"[\u0370-\u03ff\u1f00-\u1fff]", "cyrillic": r"[\u0400-\u052f]", "han": r"[\u3400-\u9fff]"}


def plain_kept(rows, model):
    """The verdicts, from bands made in plain loops."""
    texts = []
    for i, t, lang in rows:
        values = dict(zip(fertility.MEASURES, measures(t, model), strict=True))
        n = sum(len(model.encode(w)) for w in re.findall(r"[^\x20\x09-\x0D]+", t))
        letters = {k: len(re.findall(p, "".join(t.split()))) for k, p in sorted(SCRIPT.items())}
        script = max(letters, key=letters.get) if any(letters.values()) else ""
        texts.append((i, lang, script, int(math.log2(max(n, 1))), values, base(t)[-1]))
    good = [x for x in texts if not x[5]]
    out = {}
    for i, lang, script, size, values, failed in texts:
        if failed:
            out[i] = False
            continue
        for group in ([x for x in good if x[1] == lang], [x for x in good if x[2] == script], good):
            if len(group) >= fertility.LEAST:
                break
        near = next((r for r in range(64) if sum(abs(x[3] - size) <= r for x in group) >= fertility.LEAST), 63)
        held = [x for x in group if abs(x[3] - size) <= near]
        kept = True
        for m, (grid, width) in fertility.MEASURES.items():
            cells = sorted(math.floor(x[4][m] * grid) for x in held)
            q1, q2, q3 = (cells[max(math.ceil(q * len(cells)) - 1, 0)] for q in (0.25, 0.5, 0.75))
            spread = (fertility.REACH + near) * (q3 - q1)
            low, high = min((q1 - spread) / grid, q2 / grid - width), max((q3 + 1 + spread) / grid, (q2 + 1) / grid + width)
            kept = kept and low <= values[m] <= high
        out[i] = kept
    return out


def test_verdicts_against_plain_loops(spark, model):
    """Languages of many, few and one text, in several scripts, with length classes of their own."""
    rnd = random.Random(6)
    parts = {"en": ["ther", "ing", "con"], "fr": ["été", "que", "ment"], "ru": ["ста", "про", "ние"], "el": ["και", "του", "στη"], "zh": ["中文", "的是"], "bg": ["ция", "пре"]}
    rows = []
    for lang, count in (("en", 90), ("fr", 30), ("ru", 25), ("bg", 6), ("el", 3), ("zh", 1), (None, 4)):
        for _ in range(count):
            own = parts.get(lang, parts["en"])
            junk = rnd.random() < 0.2
            words = ["".join(rnd.choice(own) for _ in range(2)) + ("%&*" if junk and rnd.random() < 0.8 else "") for _ in range(rnd.choice([5, 12, 40, 41, 90, 400]))]
            rows.append((len(rows), " ".join(w + str(rnd.randrange(99)) for w in words), lang))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    got = {r.doc_id: r.kept for r in quality_rules(docs).collect()}
    want = plain_kept(rows, model)
    assert got == want and 0 < sum(want.values()) < len(want)
    few = [r for r in rows if r[2] in ("zh", None)][:3]
    docs = spark.createDataFrame(few, "doc_id bigint, text string, lang string")
    assert {r.doc_id: r.kept for r in quality_rules(docs).collect()} == plain_kept(few, model)


def test_every_text_has_a_band(spark):
    rows = [(i, " ".join(f"word{j}" for j in range(12 + i)), f"lang{i}") for i in range(30)]
    measured = quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert all(r.kept for r in measured.collect())  # alike, though each is alone in its language


def test_small_classes_take_their_neighbours(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice(["ther", "ing", "con", "ation"]) for _ in range(2))
    rows = [(i, " ".join(word() for _ in range(100)), "en") for i in range(100)]
    rows += [(1000, " ".join("%&*" + chr(0x1F600 + rnd.randrange(50)) for _ in range(1500)), "en")]  # alone in its length class
    rows += [(1001, " ".join(word() for _ in range(45)), "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert not got[1000].base_failed and not got[1000].kept
    assert got[1001].kept
