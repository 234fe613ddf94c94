import pytest
from pyspark.sql import functions as F

from tallyspan.operators import turns
from tallyspan.sources import landing, markup


def test_kinds_and_parents(spark):
    rows = [  # event, speaker
        ("member", "A"), ("announce", None), ("member", "B"), ("member", "A"), ("announce", None), ("member", "C"), ("member", "D"), ("announce", None), ("official", "O"),
        ("questions_open", None), ("official", "O"), ("announce", None), ("member", "E"), ("official", "O"), ("member", "F"), ("official", "O"), ("debate_open", None), ("official", "P"), (None, None), ("member", "G"),
    ]
    df = spark.createDataFrame([("u", i, e, s) for i, (e, s) in enumerate(rows)], "u string, i int, e string, s string").repartition(3)
    got = turns.classified(df, "u", ["i"], "e", "s", "i", block=6, one_task=2).collect()
    assert sorted((r.i, r.kind, r.parent) for r in got) == [
        (0, "speech", None), (2, "intervention", 0), (3, "reply", 0), (5, "intervention", 0), (6, "speech", None), (8, "speech", None), (10, "report", None), (12, "question", None),
        (13, "answer", 12), (14, "question", None), (15, "answer", 14), (17, "speech", None), (19, "speech", None),
    ]


@pytest.mark.parametrize(
    "text,name,want",
    [
        ("Now an intervention: Miller has the floor.", "Miller", True),
        ("There is an intervention. Please, Miller.", "Miller", True),
        ("There is an intervention. Please, Millerton.", "Miller", False),
        ("No intervention is allowed. Miller has the floor.", "Miller", False),
        ("An intervention was asked for and withdrawn. Please, Miller.", "Miller", False),
        ("An intervention. We go on. Miller has the floor.", "Miller", False),
        ("The intervention has the floor.", None, True),
        ("", "Miller", False),
        (None, "Miller", False),
    ],
)
def test_announcements(spark, text, name, want):
    df = spark.createDataFrame([(text, name)], "t string, n string")
    got = df.select(turns.announces(F.col("t"), "intervention", "has the floor", "Please", "No ", "withdrawn", F.col("n"))).first()[0]
    assert got is want


def test_batch_lists(spark, tmp_path):
    (tmp_path / "b.tsv").write_text("other\tunit\n1\t a \n2\t\n3\ta\n4\t# no\n5\tb\n")
    assert sorted(r.unit for r in landing.read_batch(spark, str(tmp_path / "b.tsv"), "unit").collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        landing.read_batch(spark, str(tmp_path / "b.tsv"), "missing")


def test_entries_and_sheets_of_pages(spark):
    html = '<p>x</p><div class="a vote-entry">1<i>2</i></div><li CLASS="vote-entry">3</li><div class="vote-entries">4</div>'
    df = spark.createDataFrame([(html,), ("none",), (None,)], "h string")
    got = [r.e for r in df.select(markup.entries("h", "vote-entry").alias("e")).collect()]
    assert got[0] == ["1<i>2</i></div>", '3</li><div class="vote-entries">4</div>'] and got[1] == []
    page = '<a href="/a.xlsx">2024-01-02: On <b>Ä-1</b>!</a><a href="/b.pdf">2024-01-02: On</a><a href="/c.xlsx">undated</a>'
    rows = markup.sheet_links(spark.createDataFrame([(page,)], "h string"), "h", r"\.xlsx$").withColumn("k", markup.letters_and_digits("title")).collect()
    assert [tuple(r) for r in rows] == [("2024-01-02", "On Ä-1 !", "/a.xlsx", "onä1")]
