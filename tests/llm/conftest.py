import pytest

SF = "/root/testdata/sf0.01"

PROSE = [f"In the year {1800 + k} the {w} ship left harbour {k} for the coast, with {k} sailors, salted fish and a cat named {w}." for k, w in enumerate("old grey tall red long blue thin wide dark pale".split())]
LONG = " ".join(f"word{k % 977}" for k in range(60_000))
TEXTS = {
    1: "\n".join(PROSE), 2: "\n".join(PROSE), 3: "\n".join(PROSE) + "\nOne more line at the end of this text.", 4: None, 5: "", 6: " \t\n ",
    7: LONG, 8: "kurz", 9: "naïve café 漢字 🙂 ▁ <|endoftext|>  two  blanks ", 10: "  " + PROSE[0].upper() + "\t\n" + "a fresh line of its own\n\n", 11: "".join(PROSE[3:]),
}


@pytest.fixture(scope="session")
def own(spark):
    """Nulls, empty and very long texts, copies, and extra columns with names that the operators use themselves."""
    rows = [(i, t, "x", 0, 1.5, [7], "tag") for i, t in TEXTS.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, class long, score double, bands array<long>, key string")


@pytest.fixture(scope="session")
def texts():
    return {i: t or "" for i, t in TEXTS.items()}


@pytest.fixture(scope="session")
def none(own):
    return own.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def all_texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}
