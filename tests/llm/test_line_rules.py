import duckdb
import pytest

from postweave.llm import line_rules
from tests.compare import differences
from tests.llm.brute import words


def repeated(text, window=8):
    w = words(text)
    seen = {}
    for k in range(len(w) - window + 1):
        seen.setdefault(tuple(w[k : k + window]), []).append(k)
    return len({k + j for places in seen.values() if len(places) > 1 for k in places for j in range(window)})


def test_same_as_sql(spark, small):
    duck = duckdb.connect()
    duck.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert differences(line_rules.line_report(docs), duck, line_rules.LINE_REPORT_SQL) == []


@pytest.mark.parametrize(
    "text",
    ["", "a", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "x " * 30, "a " * 9, " ".join(map(str, range(40))) * 2]
    + [" ".join(str(k % m) for k in range(200)) for m in (3, 7, 8, 9, 50, 150)],
)
def test_repeated_words(documents, text):
    assert line_rules.line_report(documents([(1, text)])).first().n_repeat_words == repeated(text)


def test_lines_that_fail(documents):
    sentences = [f"Sentence {k} says w{k}a and w{k}b of n{k} things here." for k in range(16)]
    good, other = " ".join(sentences[:8]), " ".join(sentences[8:])
    bad = ["Home | About | Contact | Help", "!!! ??? *** ###", "Read more", "Read more", "All rights reserved by us.", "a*** b### c$$$ d%%% e&&& f!!!"]
    row = line_rules.clean_lines(documents([(1, "\n".join([good, *bad, "", other]))])).first().rules
    assert row.clean_text == f"{good}\n{other}" and row.kept and row.n_dup_lines == 1
    lost = line_rules.clean_lines(documents([(1, "\n".join([good, *(f"{line} {k} |" for k in range(8) for line in bad)]))])).first().rules
    assert not lost.kept and not lost.base_failed


def test_cleaned_documents(documents):
    text = "One two three four five six seven eight nine ten.\nHome | About\n" + "Another line of plain words that goes on for a while here."
    out = line_rules.clean_documents(documents([(1, text), (2, "short")])).collect()
    assert [(r.doc_id, r.n_chars == len(r.text), "Home" in r.text) for r in out] == [(1, True, False)]


def test_awkward_rows(awkward):
    found = {(r.doc_id, r.n_words, r.n_repeat_words) for r in line_rules.line_report(awkward).collect()}
    assert found == {(r.doc_id, len(words(r.text)), repeated(r.text)) for r in awkward.collect()}
    assert line_rules.clean_documents(awkward).columns == awkward.columns


def test_no_rows(nothing):
    assert line_rules.line_report(nothing).collect() == []


def test_no_python_in_the_plan(spark, small, capsys):
    line_rules.line_report(small).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_a_column_named_rules_stays(documents):
    text = "This is a line of plain words that ends well, as it should in any text at all, with more than twenty words in it.\n" * 1
    frame = documents([(1, text), (2, None)]).selectExpr("*", "'mine' as rules", "'too' as rules_")
    rows = line_rules.clean_documents(frame).collect()
    assert [(r.doc_id, r.rules, r["rules_"]) for r in rows] == [(1, "mine", "too")]
