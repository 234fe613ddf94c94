import pytest
from pyspark.sql import functions as F

from tallyspan.operators import passages


def test_breaks_follow_the_corpus_and_stay_open_without_evidence(spark):
    corpus = [
        (1, "der Gartenzaun und ein U-Boot, schwarz-weiße Hunde, Apfel- und Birnensaft"),
        (2, "Know-how, Knowhow"),
    ]
    broken = {
        10: ("ein Garten-\nzaun\nfehlt", "ein Gartenzaun fehlt"),
        11: ("ein U-\nBoot taucht", "ein U-Boot taucht"),
        12: ("Kirsch- \n und Pflaumen", "Kirsch- und Pflaumen"),
        13: ("mit Know-\nhow", None),  # both spellings once
        14: ("ganz neu-\nartig", None),  # never seen
        15: ("Garten-\nzaun und neu-\nartig", None),
        16: ("Garten-\nzaun, U-\nBoot", "Gartenzaun, U-Boot"),
        17: ("eins\nzwei - drei", "eins zwei - drei"),
        18: ("", ""),
        19: ("schwarz-\nweiße\n", "schwarz-weiße"),
        20: (None, None),
    }
    texts = spark.createDataFrame([*corpus, *((k, t) for k, (t, _) in broken.items())], "k int, t string").repartition(3)
    got = {r.k: r for r in passages.rejoined(texts, "k", "t", passages.evidence(texts, "t")).collect()}
    assert {k: got[k].text for k in broken} == {k: want for k, (_, want) in broken.items()}
    assert (got[13].n_open, got[15].n_open, got[16].n_open) == (1, 1, 0)
    assert passages.rejoined(texts.limit(0), "k", "t", passages.evidence(texts, "t")).count() == 0


@pytest.mark.parametrize(
    "text,want",
    [
        ("1. eins;\n2. zwei;\n3. drei.", "kept"),
        ("1. eins;\n3. drei;\n2. zwei.", "lost"),
        ("1. bis zum\n1. Januar;\n2. zwei.", "kept"),  # a wrapped date
        ("1. eins:\na) x;\nb) y;\n2. zwei:\na) z.", "kept"),
        ("1. eins:\na) x;\nc) y.", "lost"),
        ("1. eins:\na) x:\naa) p;\nbb) q;\nb) y.", "kept"),
        ("a) x;\nb) y:\n1. p;\n2. q;\nc) z:\n1. r.", "kept"),
        ("\n".join(f"{c}) x;" for c in "abcdefghijklmnopqrstuvwxyz") + "\naa) x;\nbb) y.", "kept"),
        ("2. zwei.", "lost"),
        ("ohne Liste", "kept"),
    ],
)
def test_order_of_nested_lists(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(passages.list_order(F.split("t", "\n"))).first()[0] == want


def test_four_states(spark):
    rows = [
        (1, "vor\nRat fordert:\n1. eins;\n2. zwei.\nEnde\n9. nichts", "extracted", "1. eins; 2. zwei."),
        (2, None, "not_fetched", None),
        (3, "kein Anker", "no_passage", None),
        (4, "Rat fordert:\n1. eins;\n3. drei.", "uncertain", None),
        (5, "Rat fordert:\n1. eins und", "uncertain", None),
        (6, "Rat fordert:\n1. etwas Unge-\nsehenes.", "uncertain", None),
        (7, "Rat fordert:\nEnde", "no_passage", None),
        (8, "", "no_passage", None),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "k int, t string")
    got = {r.k: (r.state, r.passage) for r in passages.passages(df, "k", "t", "Rat fordert:", "Ende").collect()}
    assert got == {r[0]: r[2:] for r in rows}
