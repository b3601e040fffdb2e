"""Documents with everything that may be odd about them."""

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "size string, copies int, n_words string, kept int, score string"
)
WORDS = "stone river light wagon candle mirror garden silver window bridge letter marble".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def odd_rows():
    """Null ids, texts and sources; empty, blank and long texts; ties and repeated rows."""
    texts = [
        None,
        "",
        " \t\n\x0b\x0c\r ",
        "one",
        "Two words",
        prose(1, 80),
        prose(1, 80),
        prose(2, 70) + " " + prose(3, 5),
        prose(2, 70) + " " + prose(4, 5),
        "same words again " * 40,
        prose(5, 30000),
        "é ñ ß 漢字   x y İ " * 30,
        "line one here\nline one here\n\n" * 20 + prose(6, 60),
        "### $$$ &&& " * 50,
    ]
    rows = []
    for i, text in enumerate(texts):
        source = [None, "a", "b", "c", ""][i % 5]
        lang = [None, "en", "de"][i % 3]
        rows.append((i, text, lang, source, None, "x", i, "y", None, None))
    rows.append(rows[5])
    rows.append((None, prose(7, 60), None, None, None, None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None, None, None))
    return rows


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def turn_rows(seed=5, conversations=40, long=700):
    """Turns with every fault: null and tied turns, odd roles, blank, cut and repeated texts."""
    rng = random.Random(seed)
    said = ["Hi there.", "Yes!", "Well", "ok?", "", "  \t", "A\nB.", "x. \x0b", "Ça va.", None]
    roles = ["user", "assistant", "system", "tool", None, "", "uncle", "s"]
    rows = []
    for conv in [*range(conversations), None]:
        n = long if conv == 7 else rng.choice([1, 2, 5, 12, 30])
        for i in range(n):
            text = rng.choice(said) if rng.random() < 0.4 else f"say {conv} {i}{rng.choice('.!?,')}"
            turn = rng.choice([i, i, i, i, None, i // 2])
            role = rng.choice(roles) if rng.random() < 0.4 else ["user", "assistant"][i % 2]
            rows.append((conv, turn, role, text, "x", 1))
    rows += [(3, 1, "user", "Same.", "y", 2)] * 50
    rows.append((9, 0, "user", "long " * 100_000, "y", 2))
    return rows


TURN_SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, times int"


def odd_turns(spark, **how):
    return spark.createDataFrame(turn_rows(**how), TURN_SCHEMA)


def no_turns(spark):
    return spark.createDataFrame([], TURN_SCHEMA)


def stored(spark, tmp_path, **tables):
    """A folder with the given tables, as a query reads them."""
    for name, df in tables.items():
        df.coalesce(2).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def same_as_sql(df, sql, **tables):
    """Whether a result equals DuckDB's over the folders of ``tables``."""
    import duckdb

    from tests.oracle import duck_rows, spark_rows

    connection = duckdb.connect()
    for name, path in tables.items():
        connection.execute(f"create view {name} as select * from read_parquet('{path}/*.parquet')")
    return spark_rows(df) == duck_rows(connection, sql)
