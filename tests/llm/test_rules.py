"""Line-first rules against SQL, and their defined results in odd cases."""

import compare
import pytest
from fixtures import documents, frame, prose, rows_of

from clickloom.llm.quality_rules import OP8_SQL, clean, judge, op8_quality_rules


def test_matches_sql(spark, sf_dir):
    assert compare.difference(op8_quality_rules(spark, sf_dir), compare.duck(sf_dir), OP8_SQL) is None


def test_figures_by_hand(spark):
    rows = {r.doc_id: r for r in judge(frame(spark)).collect()}
    assert (rows[8].n_words, rows[8].base_failed, rows[8].kept) == (0, True, False)
    assert (rows[10].n_words, rows[10].word_chars, rows[10].n_dup_lines) == (0, 0, 0)
    assert rows[15].n_dup_lines == 1 and rows[15].kept and "Menu" not in rows[15].cleaned and rows[15].n_lost_words == 10
    assert rows[17].n_symbols == 15 * 9 and not rows[17].kept
    assert rows[16].n_repeat_words == rows[16].n_words and rows[16].base_failed
    assert rows[13].kept and rows[1].kept and rows[18].base_failed == (rows[18].n_words < 20 or rows[18].n_repeat_words > 0.3 * rows[18].n_words)


def test_repeats_count_covered_words(spark):
    half = prose(20, 10, 10)
    text = f"{half} middle {half} tail"
    row = judge(frame(spark, [(1, text, "", "", 0, 0, "", "", 0, "")])).first()
    words, covered = text.split(), set()
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered |= set(range(i, i + 8))
    assert row.n_repeat_words == len(covered) == 20


def test_clean_keeps_columns(spark):
    out = clean(frame(spark))
    assert out.columns == frame(spark).columns and out.count() == sum(r.kept for r in judge(frame(spark)).collect())
    assert all(r.n_chars == len(r.text) for r in out.collect()) and {r.kept for r in out.collect()} == {"x"}
    assert clean(frame(spark, [])).collect() == [] and rows_of(judge(frame(spark, []))) == []


@pytest.mark.parametrize("build", [judge, clean])
def test_no_python_on_the_way(spark, build):
    plan = build(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Exchange"))
    assert documents()
