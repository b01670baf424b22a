import pytest
from brute import CLASHING, edge_rows, frame, unit_removals

from vetrow.llm import line_dedup


def test_edge_table_against_brute_force(spark):
    rows = edge_rows()
    gone = unit_removals(rows)
    out = line_dedup.dedup_units(frame(spark, rows, CLASHING), window=2).collect()
    assert len(out) == len(rows)
    want = {}
    for r, (d, text) in enumerate(rows):
        spans = [(a, b) for a, b in line_dedup.cut_units(text or "") if (r, a) in gone]
        kept, at = "", 0
        for a, b in spans:
            kept += (text or "")[at:a]
            at = b
        kept = text if not spans else kept + text[at:]
        want.setdefault((d, text), (kept, len(spans), sum(b - a for a, b in spans)))
    texts = {d: t for d, t in rows}
    for r in out:
        kept, n, chars = want[r["doc_id"], texts[r["doc_id"]]]
        assert (r["text"], r["_n_removed"], r["_removed_chars"]) == (kept, n, chars)
        assert r["label"] == "extra"
        spans = [tuple(map(int, s.split("-"))) for s in r["_removed_spans"].split(",") if s]
        assert sum(b - a for a, b in spans) == chars
    assert sum(r["_n_removed"] for r in out) > 20


def test_shared_passage_goes_even_between_sentences(spark):
    passage = "Here are words of a passage that many pages share. So it is. It has a few sentences, some quite short. Yes. And it ends here with these words."
    rows = [(3, f"Intro of the third page is this one here. {passage} Then the third page goes on alone."), (1, f"{passage}"),
            (2, f"Second pages begin in their own way as well. {passage}")]
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup_units(frame(spark, rows), window=2).collect()}
    assert out[1] == passage
    assert out[2] == "Second pages begin in their own way as well. "
    assert out[3] == "Intro of the third page is this one here. Then the third page goes on alone."


@pytest.mark.parametrize("unit", ["line", "paragraph", "sentence"])
def test_units_cover_the_text(unit):
    for _, text in edge_rows():
        units = line_dedup.cut_units(text or "", unit)
        assert "".join((text or "")[a:b] for a, b in units) == (text or "")


def test_empty_table(spark):
    assert line_dedup.dedup_units(frame(spark, [])).collect() == []


def test_windows_take_short_units_and_scripts_without_blanks(spark):
    lines = "Red apples\nGreen pears\nRipe plums\nSweet figs\nFresh dates\n"
    menu = "tea\ncake\nsoup\nbread\nrice\n\nfish\nmilk\n"
    han = "这是一个没有空格的很长的句子。\n它在两份文件里出现。"
    rows = [(1, lines), (2, "A page that opens in quite its own way here.\n" + lines + "It ends alone with words found nowhere else."),
            (3, menu), (4, menu), (5, "only three words"), (6, "only three words"), (7, han), (8, han), (9, "完全相同的一行文字"), (10, "完全相同的一行文字"),
            (11, "Yes.\nThis line has words that no other text has."), (12, "Yes.\nAnother line whose words are all its own too.")]
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup_units(frame(spark, rows), window=None).collect()}
    stay = {2: "A page that opens in quite its own way here.\nIt ends alone with words found nowhere else.", 4: "", 6: "", 8: "", 10: ""}
    assert out == {d: stay.get(d, t) for d, t in rows}


def test_every_unit_with_words_is_compared():
    for _, text in [*edge_rows(), (0, "a\n \nb\nc\n\n d e f g\nh"), (0, "一\n二")]:
        units, found = line_dedup.unit_windows(text or "")
        assert {k for _, i, j in found for k in range(i, j + 1)} >= {k for k, (a, b) in enumerate(units) if text[a:b].strip()}
