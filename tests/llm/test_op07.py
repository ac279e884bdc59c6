"""Language profiles against plain counts; accuracy on documents held out."""

from collections import Counter

from pyspark.sql import functions as F

from finsieve.llm import op07_language as lang
from finsieve.llm.common import held_out, table
from tests.conftest import ORACLE
from tests.llm.helpers import AWKWARD, docs


def grams(text):
    words = lang.letters(text).split()
    out = Counter()
    for w in words:
        w = f" {w} "
        for n in (1, 2, 3):
            out.update(g for g in (w[i:i + n] for i in range(len(w) - n + 1)) if g != " ")
    return out


def packed(gram):
    number = 0
    for c in gram:
        number = number << 21 | ord(c)
    return number


def ranks(counts, top):
    return {g: i for i, (g, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], packed(x[0])))[:top])}


def test_profiles_and_distances(spark):
    texts = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, "THE END", "en"), (4, None, "de"), (5, "123", "de"),
             (6, "ein Hund", None), (7, "\U00020000一 cat the", "zh"), (8, "the", "en")]
    frame = docs(spark, texts)
    known = lang.profiles(frame, F.lit(True), top=20)
    got = {}
    for r in known.collect():
        got.setdefault(r.lang, {})[r.gram] = r.rank
    want = {}
    for code in ("en", "de", "zh"):
        total = Counter()
        for _, t, c in texts:
            if c == code:
                total.update(grams(t))
        want[code] = {packed(g): r for g, r in ranks(total, 20).items()}
    assert got == want
    out = {r.id: (r.lang_pred, r.score) for r in lang.identify(frame, known, top=20).collect()}
    for i, t, _ in texts:
        own = {packed(g): r for g, r in ranks(grams(t), 20).items()}
        if not own:
            assert out[i] == ("und", 0.0)
            continue
        far = {c: sum(abs(p[g] - r) if g in p else 20 for g, r in own.items()) for c, p in want.items()}
        best = min(sorted(far), key=far.get)
        assert out[i][0] == best and abs(out[i][1] - (1 - far[best] / (20 * len(own)))) < 1e-12


def test_awkward_rows(spark):
    frame = docs(spark, AWKWARD)
    out = lang.identify(frame, lang.profiles(frame, F.lit(True))).collect()
    assert sorted(str(r.id) for r in out) == sorted(str(i) for i, _ in AWKWARD)
    assert {r.id for r in out if r.lang_pred == "und"} == {1, 2, 3, 10}
    none = lang.profiles(docs(spark, []), F.lit(True))
    assert {(r.lang_pred, r.score) for r in lang.identify(frame, none).collect()} == {("und", 0.0)}
    assert lang.identify(docs(spark, []), none).count() == 0


def test_held_out_accuracy(spark):
    frame = table(spark, ORACLE, "documents")
    out = lang.identify(frame, lang.profiles(frame, ~held_out(F.col("doc_id"), 5, 0)))
    rows = out.join(frame, F.col("id") == F.col("doc_id")).filter(held_out(F.col("doc_id"), 5, 0)).select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows) > 0
