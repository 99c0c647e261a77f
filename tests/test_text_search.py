import random
import re
import unicodedata

import pytest
from conftest import ids, plan_of
from pyspark.sql import functions as F

from seekframe.functions.tokens import TOKENIZERS, tokens, word_ngrams, words
from seekframe.operators import index as ix
from seekframe.operators import impacts, lexicon, search, similar, terms
from seekframe.session import scratch_path

C = F.col


# --- a plain Python statement of the token rules ---------------------------------------------

def char_class(ch):
    name = unicodedata.name(ch, "")
    if name.startswith(("CJK UNIFIED", "HIRAGANA", "KATAKANA LETTER")) or ch == "ー":
        return "cjk"
    kind = unicodedata.category(ch)[0]
    return {"L": "alpha", "N": "digit"}.get(kind, "symbol")


def cut(text, spec):
    text = text.lower()
    chunks = ["".join(text.split())] if spec.ignore_blank else text.split()
    out = []
    for chunk in chunks:
        runs, last = [], None
        for ch in chunk:
            kind = char_class(ch)
            kind = "grams" if kind == "cjk" or kind in spec.split else kind
            if kind == last:
                runs[-1][1] += ch
            else:
                runs.append([kind, ch])
            last = kind
        for kind, run in runs:
            if kind == "grams" and len(run) > spec.n:
                out += [run[i:i + spec.n] for i in range(len(run) - spec.n + 1)]
            else:
                out.append(run)
    return out


TEXTS = [
    "Hello, World! 123", "日本語テキスト検索", "東京tower 2020年", "a", "あ", "", "   ", "ＡＢＣ abc",
    "x--y  ++ z9z", "スーパー3000!?", "é à ü", "Tab\tand\nline", "😀😀 ok 😀", "検", "kg㎏ ②",
]


@pytest.mark.parametrize("name", [n for n, s in TOKENIZERS.items() if not s.delimiter])
def test_tokenizers(spark, name):
    rng = random.Random(7)
    texts = TEXTS + ["".join(rng.choice("ab1 ,。漢字かなカナー \n9é#") for _ in range(rng.randint(0, 40)))
                     for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["ts"] for r in df.select("i", tokens(C("t"), name).alias("ts")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == cut(text, TOKENIZERS[name]), text


def test_delimiters(spark):
    df = spark.createDataFrame([("a  B c-d", "x y\0Z\0\0w")], "a string, b string")
    row = df.select(tokens(C("a"), "TokenDelimit"), tokens(C("b"), "TokenDelimitNull")).head()
    assert tuple(row) == (["a", "b", "c-d"], ["x y", "z", "w"])


def test_long_cjk_run(spark):
    df = spark.createDataFrame([("漢字" * 5000,)], "t string")
    assert df.select(F.size(tokens(C("t")))).head()[0] == 9999


def test_word_ngrams(spark):
    df = spark.createDataFrame([("One, two three",), ("one",), ("",)], "t string")
    got = [r[0] for r in df.select(words(C("t")).alias("w")).select(word_ngrams(C("w"), 3)).collect()]
    assert got == [["one", "two", "three", "one two", "two three", "one two three"], ["one"], []]


@pytest.fixture(scope="module")
def random_docs(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice("aa bb cc dd ee ff gg".split())
                         for _ in range(rng.randint(0, 25)))) for i in range(300)]
    return rows, spark.createDataFrame(rows, "_id long, t string")


@pytest.mark.parametrize("query, distance", [("aa bb", 1), ("aa bb cc", 3), ("gg", 0),
                                             ("aa ff gg ee", 5), ("aa aa", 4)])
def test_near(random_docs, query, distance):
    rows, df = random_docs
    terms = set(query.split())

    def span(text):
        ts = text.split()
        best = None
        for i in range(len(ts)):
            for j in range(i, len(ts)):
                if terms <= set(ts[i:j + 1]):
                    best = j - i if best is None else min(best, j - i)
                    break
        return best

    want = {i: span(t) for i, t in rows if span(t) is not None and span(t) <= distance}
    got = search.near(df, "t", query, distance)
    assert {r["_id"]: r["_span"] for r in got.collect()} == want
    assert "Exchange" not in plan_of(got)


def test_phrase_by_index(random_docs, spark):
    rows, df = random_docs
    for phrase in (["aa", "bb"], ["cc"], ["aa", "aa"], ["aa", "bb", "aa"]):
        want = {}
        for i, text in rows:
            ts = text.split()
            n = sum(ts[k:k + len(phrase)] == phrase for k in range(len(ts)))
            if n:
                want[i] = n
        index = ix.build_postings(df, "_id", ["t"])
        assert ix.phrase_tokens(df, " ".join(phrase)) == phrase
        got = ix.match_phrase(index, "_id", phrase)
        assert {r["_id"]: r["_score"] for r in got.collect()} == want


def test_index(spark):
    df = spark.createDataFrame([(1, "Red ring", "promo red"), (2, "blue", "ring ring")],
                               "_id long, a string, b string")
    index = ix.build_postings(df, "_id", {"a": 10, "b": 3}, sections=True, weights=True)
    assert sorted(tuple(r) for r in index.filter("token = 'ring'").collect()) == [
        (1, "ring", 1, 1, 10), (2, "ring", 0, 2, 3), (2, "ring", 1, 2, 3)]
    assert {tuple(r) for r in ix.match_terms(index, "_id", ["red", "ring"]).collect()} == {
        (1, 23), (2, 6)}
    assert ids(ix.match_terms(index, "_id", ["red", "ring"], require_all=True)) == [1]
    # Phrases do not run over from one column into the next.
    assert ix.match_phrase(index, "_id", ["ring", "promo"]).count() == 0
    path = scratch_path(spark, "index")
    ix.write_index(index, "_id", path)
    stored = ix.read_index(spark, path)
    stats = {r["token"]: (r["df"], r["tf"]) for r in ix.term_stats(stored, "_id").collect()}
    assert stats == {"red": (1, 2), "ring": (2, 3), "promo": (1, 1), "blue": (1, 1)}
    found = ix.read_index(spark, path, ["red", "blue"])
    assert sorted(r["token"] for r in found.collect()) == ["blue", "red", "red"]
    plan = plan_of(found)
    assert "In(token, [blue,red])" in plan
    assert re.search(r"PartitionFilters: \[\(+_bucket#", plan)
    assert ix.read_index(spark, path, []).count() == 0


def test_escalation(spark):
    df = spark.createDataFrame([(1, "a cat"), (2, "cats and dogs"), (3, "concat"), (4, "dog"),
                                (5, "The CAT")], "_id long, t string")
    tiers = lambda n: {r["_id"]: r["_tier"] for r in
                       search.match_escalation(df, "t", "Cat", n).collect()}
    assert tiers(0) == tiers(1) == {1: 1, 5: 1}
    assert tiers(2) == {1: 1, 5: 1, 2: 2}
    assert tiers(3) == tiers(99) == {1: 1, 5: 1, 2: 2, 3: 3}


def test_similar(spark):
    df = spark.createDataFrame([(1, "red blue, green"), (2, "red"), (3, "xyz"), (4, "")],
                               "_id long, t string")
    got = search.similar(df, "t", "Red green yellow", 0.1)
    assert {r["_id"]: r["_similarity"] for r in got.collect()} == {1: 0.5, 2: 0.333333}
    assert "Exchange" not in plan_of(got)


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_term_extract(random_docs, spark, broadcast_rows):
    rows, df = random_docs
    wanted = ["aa", "bb cc", "gg gg gg", "zz"]
    vocabulary = spark.createDataFrame([(t,) for t in wanted], "_key string")
    want = {}
    for i, text in rows:
        ts = text.split()
        for term in wanted:
            k = len(term.split())
            n = sum(" ".join(ts[a:a + k]) == term for a in range(len(ts) - k + 1))
            if n:
                want[i, term] = n
    got = terms.term_extract(df, "_id", "t", vocabulary, broadcast_rows=broadcast_rows)
    assert {(r["_id"], r["term"]): r["n"] for r in got.collect()} == want


def test_words_ignore_punctuation(spark):
    df = spark.createDataFrame([("Don't stop, 42nd st.",)], "t string")
    assert df.select(words(C("t"))).head()[0] == re.findall(r"[^\W\d_]+|\d+", "don't stop, 42nd st.")


def test_near_takes_terms_of_several_tokens(spark):
    df = spark.createDataFrame([(1, "an e-mail for the client"), (2, "東京都と大阪府"), (3, "mail client")],
                               "_id long, body string")
    assert ids(search.near(df, "body", "E-mail client")) == [1]
    assert ids(search.near(df, "body", "東京都 大阪府")) == [2]
    assert ids(search.near(df, "body", "e-mail client", distance=1)) == []


def test_term_extract_cuts_terms_like_texts(spark):
    df = spark.createDataFrame([(1, "Arch Linux sends e-mail to new york city hall")], "_id long, body string")
    listed = spark.createDataFrame([("Arch Linux",), ("E-Mail",), ("New York City Hall",), ("linux arch",), ("!",)],
                                  "_key string")
    got = {(r["term"], r["n"]) for r in terms.term_extract(df, "_id", "body", listed).collect()}
    assert got == {("arch linux", 1), ("e mail", 1), ("new york city hall", 1)}


@pytest.mark.parametrize("buckets", [1, 16, 256])
def test_stored_index_knows_its_buckets(spark, tmp_path, buckets):
    df = spark.createDataFrame([(i, f"word{i} linux") for i in range(20)], "_id long, body string")
    path = str(tmp_path / "index")
    ix.write_index(ix.build_postings(df, "_id", ["body"]), "_id", path, buckets)
    more = spark.createDataFrame([(99, "Linux added")], "_id long, body string")
    ix.write_index(ix.build_postings(more, "_id", ["body"]), "_id", path, 3)
    held = ix.read_index(spark, path, ["Linux"])
    assert sorted(ids(ix.match_terms(held, "_id", ["Linux"]))) == [*range(20), 99]
    plan = plan_of(held)
    assert re.search(r"PartitionFilters: \[.*_bucket#", plan) and "EqualTo(token,linux)" in plan


def test_term_extract_ends_where_no_term_goes_on(spark, monkeypatch):
    """One term of 200 words: three levels are walked, as far as any text follows it."""
    long = " ".join(f"w{chr(97 + i % 26)}{i}" for i in range(200))
    longest = " ".join(words_of(long))
    texts = [(1, "wa 0 wb 1 other words"), (2, "nothing"), (3, None), (4, ""), (4, "wa 0")]
    df = spark.createDataFrame(texts, "_id long, body string")
    listed = spark.createDataFrame([(long,), ("wa 0",), ("",), (None,), ("0 wb",), ("0 WB",)], "_key string")
    written = []
    monkeypatch.setattr(terms, "materialise", lambda d, label: written.append(label) or d.cache())
    got = {(r["_id"], r["term"]): r["n"] for r in terms.term_extract(df, "_id", "body", listed).collect()}
    assert got == {(1, "wa 0"): 1, (1, "0 wb"): 1, (4, "wa 0"): 1}
    assert written.count("term-level") <= 6
    whole = spark.createDataFrame([(9, long)], "_id long, body string")
    assert longest in {r["term"] for r in terms.term_tree(listed).filter("term is not null").collect()}
    assert terms.term_extract(whole.limit(0), "_id", "body", listed).collect() == []
    assert terms.term_extract(whole, "_id", "body", listed.limit(0)).collect() == []


def words_of(text):
    return re.findall(r"[^\W\d_]+|\d+", text.lower())


@pytest.mark.parametrize("threshold, broadcast_rows", [(0.2, 0), (0.5, 1000), (0.8, 1000), (1.0, 1000)])
def test_similar_batch(spark, threshold, broadcast_rows):
    draw = random.Random(7)
    letters = "abcdefghijklmnopqrst"
    common = [" ".join(draw.choices(letters, weights=range(20, 0, -1), k=draw.randint(0, 12))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(common)] + [(200 + i, "same words in copies") for i in range(20)]
    rows += [(300, None), (301, "copies in words same"), (302, "!"), (None, "a b c"), (0, "a b")]
    asked = [(i, t) for i, t in rows if i is not None and i % 10 == 0] + [(900, "unknown zebra"), (901, "a b unknown")]
    bag = lambda t: set(words_of(t or ""))
    want = sorted((q, i, round(len(bag(a) & bag(b)) / len(bag(a) | bag(b)), 6))
                  for q, a in asked for i, b in rows if i is not None and bag(a) and bag(b)
                  and round(len(bag(a) & bag(b)) / len(bag(a) | bag(b)), 6) >= threshold)
    df = spark.createDataFrame(rows, "_id long, t string").selectExpr("*", "1 AS word", "2 AS q")
    queries = spark.createDataFrame(asked, "asker long, t string")
    got = similar.similar_batch(df, "_id", "t", queries, "asker", "t", threshold, broadcast_rows)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert similar.similar_batch(df.limit(0), "_id", "t", queries, "asker", "t", threshold).collect() == []


def test_similar_batch_meets_on_rare_words_only(spark):
    """Texts that share but a frequent word are never a pair: their prefixes hold rarer ones."""
    df = spark.createDataFrame([(i, f"the a{chr(97 + i % 26)}x b{chr(97 + i // 26)}y rare{'z' * i}") for i in range(100)],
                               "_id long, t string")
    sets = similar._sets(df, "_id", "t")
    kept = similar._prefixes(sets, similar.ranked_words(sets), 0.8, 1000)
    assert "the" not in {r.word for r in kept.collect()}


def test_similar_batch_writes_few_pairs(spark, monkeypatch):
    """Texts meet on rare words without being similar; such pairs are not written."""
    draw = random.Random(1)
    pool = [f"w{chr(97 + w % 26)}{chr(97 + w // 26)}" for w in range(600)]
    rows = [(i, " ".join(draw.sample(pool, 60))) for i in range(120)] + [(500, "wa wb")]
    rows += [(200 + i, t + " more") for i, t in rows[:9]]
    df = spark.createDataFrame(rows, "_id long, t string")
    written = []

    def write(d, label):
        d = d.cache()
        if label in ("similar-met", "similar-pairs"):
            written.append(d.count())
        return d
    monkeypatch.setattr(similar, "materialise", write)
    monkeypatch.setattr(similar, "BLOCK_WORDS", 1500, raising=False)
    monkeypatch.setattr(similar, "AT_ONCE", 70, raising=False)
    got = similar.similar_batch(df, "_id", "t", df.select(C("_id").alias("asker"), "t"), "asker", "t", 0.6).collect()
    bags = {i: set(t.split()) for i, t in rows}
    assert sorted((r.asker, r._id) for r in got) == sorted(
        (a, b) for a in bags for b in bags if len(bags[a] & bags[b]) / len(bags[a] | bags[b]) >= 0.6)
    assert 0 < sum(written) <= 3 * len(got)


@pytest.mark.parametrize("weights, intervals", [(False, 500), (True, 0)])
def test_top_terms_open_few_ranges(spark, monkeypatch, tmp_path, weights, intervals):
    monkeypatch.setattr(impacts, "INTERVALS", intervals)
    draw = random.Random(3)
    rows = [(i - 50, " ".join(draw.choices(["linux", "arch", "kernel", "x"], k=3)), "arch" * (i % 2)) for i in range(600)]
    rows[400] = (350, "linux " * 9 + "arch arch", "arch")
    rows[401] = (351, "Linux " * 8, "")
    df = spark.createDataFrame(rows, "_id long, body string, title string")
    columns = {"title": 10, "body": 3} if weights else ["body"]
    index = ix.build_postings(df, "_id", columns, weights=weights)
    ix.write_index(index, "_id", str(tmp_path / "index"), 4)
    impacts.write_impacts(impacts.build_impacts(index, "_id", 16), str(tmp_path / "impacts"), 4)
    for wanted, k in ((["Linux", "arch"], 1), (["kernel"], 700), (["arch", "absent"], 30), (["absent"], 3)):
        held = ix.read_index(spark, str(tmp_path / "index"), wanted)
        bound = impacts.read_impacts(spark, str(tmp_path / "impacts"), wanted)
        every = sorted(((-r._score, r._id) for r in ix.match_terms(held, "_id", wanted).collect()))[:k]
        got = [tuple(r) for r in impacts.top_terms(held, bound, "_id", wanted, k).collect()]
        assert got == [(i, -s, n) for n, (s, i) in enumerate(every, 1)]
    if not weights:
        held = ix.read_index(spark, str(tmp_path / "index"), ["linux", "arch"])
        bound = impacts.read_impacts(spark, str(tmp_path / "impacts"), ["linux", "arch"])
        opened = impacts.opened_ranges(held, bound, "_id", ["linux", "arch"], 2)
        read = impacts._within(held, "_id", opened).count()
        assert opened.count() == 1 and read < held.count() / 20


def test_postings_are_shuffled_in_packs(spark, monkeypatch, tmp_path):
    """A pack takes few bytes a posting and gives back every row; impacts are those of the postings,
    also where ids come twice or are null."""
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choices(["linux", "arch", "kernel", "x", "ÿ"], k=30))) for i in range(300)]
    rows += [(7, "linux arch"), (None, "linux linux"), (None, "x"), (400, None)]
    df = spark.createDataFrame(rows, "_id long, t string")
    index = ix.build_postings(df, "_id", ["t"]).cache()
    table = index.withColumn("_bucket", F.length("token") % 2).toArrow()
    packs = ix.packed(table, "_bucket")
    back = [r for part in ix.unpacked(packs.column(1)) for r in part.to_pylist()]
    key = lambda r: tuple(str(r[c]) for c in index.columns)
    assert sorted(map(key, back)) == sorted(key(r.asDict()) for r in index.collect())
    assert len(packs) == 2 and sum(len(p) for p in packs.column(1).to_pylist()) < 3 * len(table)
    ix.write_index(index, "_id", str(tmp_path), 3)
    stored = ix.read_index(spark, str(tmp_path))
    assert sorted(map(key, (r.asDict() for r in stored.collect()))) == sorted(map(key, back))
    monkeypatch.setattr(impacts, "PART_POSTINGS", 500)
    per_doc = index.groupBy("token", "_id").agg(F.count("*").alias("n"))
    start = C("_id") - F.pmod(C("_id"), F.lit(16))
    want = per_doc.groupBy("token", start.alias("start")).agg(F.max("n").alias("most"), F.count("*").alias("docs"))
    got = impacts.build_impacts(stored, "_id", 16, 3)
    assert sorted(map(str, got.select("token", "start", "most", "docs").collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("tokenizer, listed, terms", [
    ("TokenBigram", 500, ["Ab", "漢", "字カ漢", "b漢", "a b", " ", "zz"]),
    ("TokenBigram", 0, ["a", "漢字", "a b"]),
    ("TokenBigramSplitSymbolAlpha", 500, ["ab", "aab", "1,"]),
    ("TokenBigramIgnoreBlankSplitAlpha", 500, ["ab", "a b"]),
    ("TokenDelimitNull", 500, ["a b", "ab"])])
def test_escalation_from_lexicon(spark, monkeypatch, tmp_path, tokenizer, listed, terms):
    monkeypatch.setattr(lexicon, "LISTED", listed)
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("ab1 ,漢字カ\n'\0") for _ in range(rng.randint(0, 14))))
            for i in range(250)] + [(900, None), (901, ""), (902, "ab漢字 aab\tb" * 2000)]
    df = spark.createDataFrame(rows, "_id long, t string")
    held, path = str(tmp_path / "held"), str(tmp_path / "lexicon")
    ix.write_index(lexicon.held_tokens(df, "_id", "t", tokenizer), "_id", held, 4)
    early = ix.read_index(spark, held).filter("_id < 100")
    lexicon.write_lexicon(early, path, 3)
    lexicon.extend_lexicon(ix.read_index(spark, held), path, 5)
    stored = spark.read.parquet(f"{path}/tokens")
    assert stored.count() == stored.select("token").distinct().count()
    for term in terms:
        want = search.match_escalation(df, "t", term, 60, tokenizer)
        got = lexicon.match_escalation(
            spark, path, lambda tokens: ix.read_tokens(spark, held, tokens), df, "_id", "t",
            term, 60, tokenizer)
        assert sorted(map(tuple, got.collect())) == \
            sorted((r["_id"], r["_tier"]) for r in want.collect()), term


def test_escalation_reads_texts_over_blanks_only(spark, tmp_path):
    df = spark.createDataFrame([(1, "a cat"), (2, "cats and dogs"), (3, "concat"), (4, "dog")],
                               "_id long, t string")
    path = str(tmp_path / "lexicon")
    held = lexicon.held_tokens(df, "_id", "t")
    lexicon.write_lexicon(held, path, 2)
    asked = []

    def postings(tokens):
        asked.append(sorted(tokens))
        return held.filter(C("token").isin(tokens))

    def run(term, threshold, texts):
        asked.clear()
        return {tuple(r) for r in lexicon.match_escalation(
            spark, path, postings, texts, "_id", "t", term, threshold).collect()}

    none = df.filter("false")
    assert run("cat", 0, none) == {(1, 1)} and asked == [["cat"]]
    assert run("cat", 1, none) == {(1, 1), (2, 2)} and asked == [["cat"], ["cats"]]
    assert run("cat", 9, none) == {(1, 1), (2, 2), (3, 3)} and asked[2] == ["concat"]
    assert run("a cat", 0, none) == set() and run("a cat", 0, df) == {(1, 3)}
    plan = plan_of(lexicon.tokens_starting(spark, path, "ca"))
    assert "StringStartsWith(token,ca)" in plan
