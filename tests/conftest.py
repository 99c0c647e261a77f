import datetime as dt

import pytest

from seekframe.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "2",
        "spark.default.parallelism": "2",
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(work / "shared"),
        "spark.sql.warehouse.dir": str(work / "warehouse"),
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# Rows whose results the goldens are stated for. Bodies are cut to the words used.
ARTICLES = [
    (1, "key1", "Arch Linux", "Arch Linux is a Linux-based operating system"),
    (2, "key2", "Gentoo Linux", "Gentoo Linux is built on top of the Linux kernel"),
    (3, "key3", "Nyarlathotep", "a malign deity in the Cthulhu Mythos"),
    (4, "key4", "Cthugha", "a fictional deity in the Cthulhu Mythos genre"),
    (5, "key5", "Hastur", "a fictional entity of the Cthulhu Mythos"),
]
CHARACTERS = [
    (1, "key1", "VOCALOID", "Miku Hatsune"),
    (2, "key2", "VOCALOID", "Luka Megurine"),
    (3, "key3", "VOCALOID", "MEIKO"),
    (4, "key4", "Ghostory", "Hitagi Senjogahara"),
    (5, "key5", "Ghostory", "Shinobu Oshino"),
    (6, "key6", "BLACK LAGOON", "Revy"),
    (7, "key7", "BLACK LAGOON", "Rock"),
    (8, "key8", "BLACK LAGOON", "Roberta"),
]
PEOPLE = [
    (1, "key1", "Name1", "Address1"),
    (2, "key2", "name2", "address2"),
    (3, "key3", "foo", "bar"),
    (4, "キー４", "園城寺怜", "千里山"),
    (5, "キー５", "白水哩", "新道寺"),
]
EVENTS = [
    ("1", 803.86057, "e", ""),
    ("1", 803.96857, "en", ""),
    ("1", 804.26057, "eng", ""),
    ("1", 804.56057, "engi", ""),
    ("1", 804.76057, "engin", ""),
    ("1", 805.86057, "engine", "submit"),
    ("2", 803.86057, "s", ""),
    ("2", 803.96857, "sa", ""),
    ("2", 804.26057, "sae", ""),
    ("2", 804.56057, "saer", ""),
    ("2", 804.76057, "saerc", ""),
    ("2", 805.76057, "saerch", "submit"),
    ("2", 809.76057, "serch", ""),
    ("2", 810.86057, "search", "submit"),
    ("3", 803.86057, "search engine", "submit"),
    ("3", 808.86057, "web search realtime", "submit"),
]


def event_rows(rows, times=1):
    base = dt.datetime(2011, 8, 10, 4, 20)
    out = []
    for _ in range(times):
        for sequence, seconds, item, kind in rows:
            out.append((len(out) + 1, sequence, base + dt.timedelta(seconds=seconds), item, kind))
    return out


EVENT_SCHEMA = "_id long, sequence string, time timestamp_ntz, item string, type string"


@pytest.fixture(scope="session")
def articles(spark):
    return spark.createDataFrame(ARTICLES, "_id long, _key string, title string, body string")


@pytest.fixture(scope="session")
def characters(spark):
    return spark.createDataFrame(CHARACTERS, "_id long, _key string, category string, name string")


@pytest.fixture(scope="session")
def people(spark):
    return spark.createDataFrame(PEOPLE, "_id long, _key string, name string, address string")


def ids(df, column="_id"):
    return [row[column] for row in df.collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
