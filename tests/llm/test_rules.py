import re
from collections import Counter

from basketry.llm import rules


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0d]+", text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times, covered = Counter(grams), set()
    for i, gram in enumerate(grams):
        if times[gram] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    counts = (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )
    return counts, len(w) < 50 or 100 * len(covered) > 50 * len(w)


TEXTS = [
    "a b c a b c", "a a a a", "a a a", "x y", "one\n\none\n one\none", "\ta\x0bb\x0cc\r\n",
    "é ü 日 é ü 日 é", "# * $ % & | < >", "  a b", "a b a b a b c d e a b a",
]


def test_counts_equal_plain_python(docs):
    rows = [(i, t, "en", "a", 0) for i, t in enumerate([*TEXTS, *(" ".join(TEXTS) * k for k in (1, 5))])]
    for frame in (docs(rows), docs()):
        for r in rules.measure(frame).collect():
            counts, failed = plain(r.text)
            assert (tuple(r[c] for c in rules.COUNTS), r.base_failed) == (counts, failed)


def test_outliers_go_and_small_groups_use_larger_ones(docs):
    clean = "plain words of a text number {} that say a little and go on for a while "
    rows = [(i, " ".join(f"{w}{i}x{j}" for j, w in enumerate(clean.split() * 4)), "en", "ab"[i % 2], 0) for i in range(600)]
    rows += [(1000, " ".join(f"{w}***&&" for w in rows[0][1].split()), "en", "a", 0)]
    rows += [(1001, rows[3][1], "en", "tiny", 0), (1002, rows[4][1], None, None, 0)]
    rows += [(1003, " ".join(f"{w}###" for w in rows[5][1].split()), "xx", "tiny", 0)]
    kept = {r.doc_id: r.kept for r in rules.verdicts(docs(rows)).collect()}
    assert not kept[1000] and not kept[1003]
    assert all(v for k, v in kept.items() if k not in (1000, 1003))
    passing = rules.passing(docs(rows))
    assert passing.columns == docs().columns
    assert {r.doc_id for r in passing.collect()} == {k for k, v in kept.items() if v}


def test_odd_rows(docs):
    result = rules.verdicts(docs()).collect()
    assert len(result) == docs().count()
    assert all(not r.kept for r in result if r.base_failed)
    assert rules.verdicts(docs([])).collect() == []
    assert rules.passing(docs([])).collect() == []


def test_the_plan_is_native(spark, sf):
    plan = rules.verdicts(spark.read.parquet(f"{sf}/documents.parquet"))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text


def test_thresholds_follow_the_number_of_documents_evenly(docs):
    """One document more changes a threshold little, and none of a small clean language goes."""
    text = lambda i, width: " ".join(f"{'w' * width}{i}x{j}" for j in range(60))
    rows = [(i, text(i, 1), "en", "a", 0) for i in range(400)]
    found = {}
    for number in (199, 200, 201):
        # Numbers of one length: else words of one digit less are the low quantile up to 200.
        long_words = [(1000 + i, text(1000 + i, 9), "xx", "b", 0) for i in range(number)]
        limits = rules.thresholds(rules.measure(docs(rows + long_words)))
        found[number] = {r.key: r.max_word_length for r in limits.collect()}
    group = next(k for k in found[200] if "xx" in k)
    assert abs(found[200][group] - found[199][group]) < 0.05
    assert abs(found[201][group] - found[200][group]) < 0.05
    few = [(2000 + i, text(i, 9), "yy", "c", 0) for i in range(20)]
    assert all(r.kept for r in rules.verdicts(docs(rows + few)).collect())
