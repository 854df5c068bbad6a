"""Operators for language-model training data on edge cases, against brute force and the public libraries."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidetable.llm import bpe, nearest, packing, percentiles, queries, stuffed
from tidetable.session import load

# nearest time

PROBE, CANDIDATE = "uid string, city string, dir int, at int, id string", "city string, dir int, origin int, id string, extra string"


def brute_match(probes, candidates, tolerance):
    out = {}
    for uid, city, d, at, _ in probes:
        if None in (uid, city, at):
            continue
        fit = [(abs(at - o), i) for c, cd, o, i, _ in candidates if None not in (c, o, i) and c == city and (d is None or cd is None or d == cd) and abs(at - o) <= tolerance]
        if fit:
            out[uid] = min(min(fit), out.get(uid, (1 << 60, "")))
    return out


def matched(spark, probes, candidates, tolerance=300):
    m = nearest.match(spark.createDataFrame(probes, PROBE), spark.createDataFrame(candidates, CANDIDATE), "uid", ["city"], "dir", "at", "origin", "id", tolerance)
    return {r.uid: (r.distance, r.match_id) for r in m.collect()}


def test_nearest_matches_brute_force(spark):
    rng = random.Random(5)
    city = lambda: rng.choice(["a", "a", "a", "a:1", "", None])
    probes = [(f"u{i}", city(), rng.choice([0, 1, None]), rng.choice([None, *[rng.randint(-700, 9000)] * 9]), "mine") for i in range(800)]
    candidates = [(city(), rng.choice([0, 1, 7, None]), rng.choice([None, *[rng.randint(-700, 9000)] * 9]), rng.choice([None, *[f"t{rng.randint(0, 150)}"] * 9]), "x") for _ in range(300)]
    assert matched(spark, probes + probes[:50], candidates + candidates[:50]) == brute_match(probes, candidates, 300)


def test_nearest_ties_bounds_and_hot_key(spark):
    candidates = [("a", 0, 3600, "z", None), ("a", 0, 3600, "b", None), ("a", 1, 3590, "c", None), ("a", None, 3610, "a", None)]
    assert matched(spark, [("u", "a", 0, 3605, None)], candidates) == {"u": (5, "a")}
    assert matched(spark, [("u", "a", 1, 3600, None)], candidates) == {"u": (10, "a")}
    assert matched(spark, [("u", "a", 0, 3300, None), ("v", "a", 0, 3299, None)], candidates[:2]) == {"u": (300, "b")}
    assert matched(spark, [], candidates) == {} and matched(spark, [("u", "a", 0, 1, None)], []) == {}
    hot = [(f"u{i}", "a", 0, i % 86_400, None) for i in range(30_000)]
    assert len(matched(spark, hot, [("a", 0, t, f"t{t:06d}", None) for t in range(0, 86_400, 300)])) == 30_000


def test_groups_are_cut_between_keys(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(nearest, "GROUP_ROWS", 3)
    rows = [(g, f"k{g}", 0, t, None if s == 0 else f"i{t}", s) for g in range(4) for t, s in [(10, 0), (12, 1), (20, 0)]]
    batch = [pa.RecordBatch.from_pylist([dict(zip(("g", "k", "bucket", "sec", "id", "side"), r, strict=True))], schema=pa.schema([("g", pa.int64()), ("k", pa.string()), ("bucket", pa.int64()), ("sec", pa.int64()), ("id", pa.string()), ("side", pa.int32())])) for r in rows]
    got = sorted((x["k"], x["sec"], x["id"], x["distance"]) for b in nearest._joined(batch, 5) for x in b.to_pylist())
    assert got == [(f"k{g}", 10, "i12", 2) for g in range(4)]


def test_clock(spark):
    rows = [("5:36:08",), ("25:00:00",), ("7:05",), ("",), (None,), ("1:99:00",)]
    assert [r.s for r in spark.createDataFrame(rows, "t string").select(nearest.clock_seconds(F.col("t")).alias("s")).collect()] == [20_168, 90_000, 25_500, None, None, None]


# percentiles


def test_bucket_error_order_and_merge(spark):
    rng = random.Random(1)
    values = [0.0, 1.0, -1.0, 1e-12, 1e9, -86_400.0, *[rng.choice([-1, 1]) * 10 ** rng.uniform(-6, 9) for _ in range(3000)]]
    df = spark.createDataFrame([(v, i % 7) for i, v in enumerate(values)] + [(None, 0)], "v double, part int")
    b = df.where("v IS NOT NULL").select("v", percentiles.bucket(F.col("v")).alias("b")).withColumn("x", percentiles.bucket_value(F.col("b"))).collect()
    assert all(abs(r.x - r.v) <= percentiles.ACCURACY * abs(r.v) * 1.0001 + 1e-9 for r in b)
    ordered = sorted(b, key=lambda r: r.v)
    assert all(p.b <= q.b for p, q in zip(ordered, ordered[1:], strict=False))
    parts = percentiles.sketch(df, ["part"], "v")
    one = percentiles.percentiles(percentiles.merge(parts, []), [], {"p10": 0.1, "p50": 0.5, "p100": 1.0}).collect()[0]
    for share, got in ((0.1, one.p10), (0.5, one.p50), (1.0, one.p100)):
        exact = sorted(values)[max(1, -(-int(len(values) * share * 1000) // 1000)) - 1]
        assert got == pytest.approx(exact, rel=0.02)


def test_buckets_of_the_least_and_greatest_doubles(spark):
    values = [float("-inf"), -1.7976931348623157e308, -1e-300, -5e-324, 0.0, 5e-324, 2.3e-308, 1e-9, 1.0, 1e300, 1.7976931348623157e308, float("inf")]
    df = spark.createDataFrame([(v,) for v in [*values, float("nan"), None]], "v double")
    b = df.select("v", percentiles.bucket(F.col("v")).alias("b")).withColumn("x", percentiles.bucket_value(F.col("b"))).collect()
    assert [r.b for r in b[len(values):]] == [None, None] and [r.b for r in b[:len(values)]] == sorted({r.b for r in b[:len(values)]})
    assert all(r.x == r.v or abs(r.x / r.v - 1) <= percentiles.ACCURACY * 1.001 for r in b[:len(values)] if abs(r.v or 1) > 1e-300)
    top = percentiles.percentiles(percentiles.sketch(df, [], "v"), [], {"p0": 0.0, "p100": 1.0}).collect()[0]
    assert (top.n, top.p0, top.p100) == (len(values), float("-inf"), float("inf"))


def test_key_marks_lose_no_partner(spark):
    keys = spark.range(1000).select(F.when(F.col("id") % 50 > 0, F.concat(F.lit("k"), F.col("id"))).alias("a"), (F.col("id") % 7).alias("b"))
    rows = spark.range(20_000).select(F.when(F.col("id") % 50 > 0, F.concat(F.lit("k"), F.col("id"))).alias("a"), (F.col("id") % 7).alias("b"))
    kept = rows.where(percentiles.key_marks(keys, ["a", "b"]))
    found = kept.join(keys.distinct(), rows["a"].eqNullSafe(keys["a"]) & (rows["b"] == keys["b"]), "left_semi").count()
    assert found == rows.where("a IS NULL OR CAST(substr(a, 2) AS INT) < 1000").count() and kept.count() < 2000
    assert rows.where(percentiles.key_marks(keys.where("false"), ["a", "b"])).count() == 0


def test_percentiles_of_nulls_and_empty(spark):
    df = spark.createDataFrame([("a", None), (None, 5.0), (None, float("nan"))], "k string, v double")
    out = percentiles.percentiles(percentiles.sketch(df, ["k"], "v"), ["k"], {"p": 0.5}).collect()
    assert [(r.k, r.n) for r in out] == [(None, 1)]
    assert percentiles.percentiles(percentiles.sketch(df.where("false"), ["k"], "v"), ["k"], {"p": 0.5}).count() == 0


def test_rank_bounds_hold(spark):
    rng = random.Random(2)
    values = [rng.randint(-300, 2000) for _ in range(2000)]
    s = percentiles.sketch(spark.createDataFrame([("a", v) for v in values], "k string, v int"), ["k"], "v")
    stated = spark.createDataFrame([(i, "a", float(v)) for i, v in enumerate([-400, 0, 17, 500.5, 1900, 5000])] + [(99, "none", 1.0)], "i int, k string, p double")
    for r in percentiles.rank_bounds(s, stated, ["k"], "p").collect():
        if r.k == "a":
            below, upto = sum(v < r.p for v in values), sum(v <= r.p for v in values)
            assert r.below_least <= below <= r.below_most and r.upto_least <= upto <= r.upto_most and r.n == 2000
        else:
            assert r.n == 0


# tokens


@pytest.fixture(scope="module")
def own():
    with open(f"{bpe.TOKENIZERS}/byte_bpe_50k.json", "rb") as f:
        return bpe.Encoder(f.read())


@pytest.fixture(scope="module")
def public():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(f"{bpe.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=["Cs", "Cn"]), max_size=60), max_size=5))
def test_ids_equal_the_public_library(own, public, texts):
    assert own.encode(texts) == [public(t) for t in texts]


def test_ids_of_odd_texts(own, public):
    for t in ["<|endoftext|> hi", "a" * 20_000, "ab" * 9_999, " \n\n  x", "   ", "\r\n\t", "don't I'LL we've", "１２３ ½ 😀👩‍👩‍👧", "路線図2025 時刻表", "​​"]:
        assert own.encode([t])[0] == public(t)
    assert own.encode([None, ""]) == [[], []]


def test_ascii_is_cut_alike(own):
    ascii_ = [chr(i) for i in range(128)]
    for a in ascii_:
        for t in [a + b for b in ascii_] + [f"x{a}'s {a}", f" {a}1 {a} ", f"{a}\n\n{a}a'LL've"]:
            assert own.cut_ascii(t) == own.cut(t), ascii(t)
    texts = ["don't stop 12 buses\t\n", None, "", "é1", "a" * 50]
    assert own.count(texts) == [len(x) for x in own.encode(texts)]


def test_p8_on_the_tables(spark, data, public):
    ids = {r.doc_id: r.ids for r in queries.p8_ids(spark, data).collect()}
    docs = load(spark, data, "documents").select("doc_id", "text").collect()
    assert ids == {r.doc_id: public(r.text) if r.text else [] for r in docs}


def test_encode_keeps_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(None, "hi", 1), (1, None, 2), (1, None, 3), (2, " ", 4)], "k int, text string, ids int")
    assert sorted(((r.k or 0), len(r.ids)) for r in bpe.encode(df, "k", "text").collect()) == [(0, 1), (1, 0), (1, 0), (2, 1)]
    assert bpe.encode(df.where("false"), "k", "text").count() == 0


# packing


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 100), max_size=150))
def test_packing_is_whole_and_within_capacity(sizes):
    bins = packing.pack(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 100 for b in bins)
    assert len(bins) <= len(packing.best_fit(sizes, 100))


def test_local_search_empties_containers():
    rng = random.Random(4)
    sizes = [rng.randint(400, 1100) for _ in range(3000)]
    start, end = packing.best_fit(sizes, 2048), packing.pack(sizes, 2048)
    squared = lambda bins: sum(sum(sizes[i] for i in b) ** 2 for b in bins)
    assert len(end) < len(start) and squared(end) > squared(start)


def test_pack_documents_splits_only_what_exceeds(spark):
    rows = [(1, 250, "x"), (2, 100, "x"), (3, 0, "x"), (4, None, "x"), (None, 30, "x"), (5, 70, "x"), (5, 70, "x"), (6, 200, "x")]
    out = packing.pack_documents(spark.createDataFrame(rows, "doc int, n int, part string"), "doc", "n", 100, F.lit(1))
    rows = out.collect()
    by = {}
    for r in rows:
        by[r.container_id] = by.get(r.container_id, 0) + r.n_tokens
    assert max(by.values()) <= 100 and sum(by.values()) == 720
    assert sorted(r.n_tokens for r in rows if r.doc == 1) == [50, 100, 100] and [r.n_tokens for r in rows if r.doc == 6] == [100, 100]
    assert sum(r.doc == 5 for r in rows) == 2 and sum(r.doc in (3, 4) for r in rows) == 2
    assert packing.pack_documents(spark.createDataFrame([], "doc int, n int"), "doc", "n", 100, F.lit(1)).count() == 0


def test_local_search_ends_where_no_exchange_helps():
    rng = random.Random(4)
    sizes = [rng.randint(400, 900) for _ in range(5000)]
    end = packing.pack(sizes, 2048)
    squared = lambda bins: sum(sum(sizes[i] for i in b) ** 2 for b in bins)
    assert squared(packing._raise_fills(end, sizes, 2048)) == squared(end) and len(end) < len(packing._raise_fills(packing.best_fit(sizes, 2048), sizes, 2048))


def test_containers_do_not_depend_on_the_split(spark):
    items = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc"), (F.col("id") * 37 % 140).alias("n"))
    n = packing.chunk_count(items, 200)
    one, other = (sorted(map(str, packing.pack_documents(items.repartition(p, "n"), "doc", "n", 100, n).collect())) for p in (1, 7))
    assert one == other and len({r.split("part=")[0].split(",")[0] for r in one}) > 4


def test_p9_fills_well(spark, data):
    packed = queries.p9_packed(spark, data)
    sizes = bpe.count_tokens(load(spark, data, "documents"), "doc_id", "text")
    assert sorted(map(tuple, packed.groupBy("doc_id").agg(F.sum("n_tokens")).collect())) == sorted(map(tuple, sizes.collect()))
    r = queries.p9_fill(spark, data).collect()[0]
    assert r.fullest <= queries.CAPACITY and r.containers <= r.fewest + 1


# stuffed pages

PROSE = "The night crew moved the spare key of the kiosk because it had been left at the depot. Riders were asked to wait until the doors on the east side could be closed. "
STUFFED = ["cheap bus pass near me, " * 40, "#TrainDeals #CheapBus #NightBus " * 20, "\n".join(f"https://www.host-{i}.example/fares" for i in range(12)), "tram timetable | " * 30,
           PROSE + "\n\n" + "; ".join(f"{a} {b}" for _ in range(12) for a in ("night bus", "day ticket", "metro map") for b in ("Corham Cross", "Zelton Works")),
           "[best coach](http://a.example/x) [day ticket](http://b.example/y) " * 8, "ｅｘｐｒｅｓｓ ｃｏａｃｈ, 3xpr3$$ c0@ch, express coach, " * 12]
GENUINE = [PROSE * 3, PROSE + "\n\nhttps://www.host.example/a", "\n".join(f"06:{i:02d}  Station {chr(65 + i)} Park" for i in range(40)), "\n".join(f"N{i}\tQuay {i} Lane\t{i}.50" for i in range(30)),
           "\n".join([PROSE.strip()] * 4), None, "", "   \n ", "\n".join(f"{i}. The chair opened item {i} and asked for the report of the depot." for i in range(1, 9))]


def test_stuffed_and_genuine_pages(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(STUFFED)] + [(100 + i, t, "x") for i, t in enumerate(GENUINE)], "doc_id int, text string, n_chars string")
    assert sorted(r.doc_id for r in stuffed.stuffed_pages(df, "doc_id", "text").collect()) == list(range(len(STUFFED)))
    assert stuffed.stuffed_pages(df.where("false"), "doc_id", "text").count() == 0


KEYWORDS = [("Die Fahrgäste wurden gebeten, bis zum Ende der Bauarbeiten am anderen Bahnsteig auf den Ersatzbus zu warten.", " | ", ["Nachtbus", "NACHTBUS", "Nachtbus"]),
            ("Die Fahrgäste wurden gebeten, bis zum Ende der Bauarbeiten am anderen Bahnsteig auf den Ersatzbus zu warten.", "\n", ["Nachtbus", "Tageskarte", "Fahrplanauskunft"]),
            ("The night crew moved the spare key of the kiosk because it had been left at the depot.", ", ", ["tickets", "trains", "buses"]), ("", ", ", ["tickets", "trains", "the", "buses", "of"]),
            ("Matkustajia pyydetään siirtymään laiturin toiseen päähän, koska juna ei ole vielä tullut.", " | ", ["Yöbussi", "Kuukausilippu", "Aikataulu"]),
            ("駅の改札は朝から混んでいるので、お客様は次の電車をお待ちください。", "、", ["バスツアー", "チケット", "タクシー"])]


def test_keywords_of_one_word_beside_prose(spark):
    stuffed_rows = [(i, f"{prose}\n\n" + sep.join(words * 20)) for i, (prose, sep, words) in enumerate(KEYWORDS)]
    # prose that outweighs the keywords, lists of words said once and repeated paragraphs are genuine
    genuine = [(100 + i, f"{prose}\n" + sep.join(words)) for i, (prose, sep, words) in enumerate(KEYWORDS) if prose]
    genuine += [(200, PROSE + "\n" + "\n".join("Alpha Beta Gamma Delta Epsilon Zeta Eta Theta Iota Kappa Lambda Mu Nu Xi Pi".split())), (201, "\n".join([PROSE.split(".")[0] + "."] * 6))]
    df = spark.createDataFrame(stuffed_rows + genuine, "doc_id int, text string")
    assert sorted(r.doc_id for r in stuffed.stuffed_pages(df, "doc_id", "text").collect()) == [i for i, _ in stuffed_rows]


def test_stuffed_pages_on_labelled_rows(spark, data):
    labels = {r.doc_id: r.stuffed for r in load(spark, data.replace("sf0.001", "sf0.1"), "labels").collect()}
    found = {r.doc_id for r in queries.p10_found(spark, data.replace("sf0.001", "sf0.1")).collect()}
    cases = {d for d, s in labels.items() if s}
    assert len(found & cases) >= 0.95 * len(cases) and len((found & labels.keys()) - cases) <= 0.05 * len(cases)


def test_features_of_a_very_long_text():
    lang, values = stuffed.features(["metro map compare " * 60_000, "x"])
    assert values["stuffed_share"][0] > 0.9 and values["n_chars"][1] == 1


@pytest.mark.parametrize("part", ["\n ", " ", "\t\n", "a", "1", ".b", "ab.cd.", "[a](b ", "a1", "a@", "$", "1,", "+1 s ", " - ", "駅の", "\u200b", "'", "#a ", "http://", "12. \n", "\r\n\u3000"])
def test_odd_long_texts_take_time_in_proportion(own, part):
    import time

    def seconds(n):
        began = time.process_time()
        stuffed.features(["x" + part * n])
        own.encode(["x" + part * n])
        return time.process_time() - began

    seconds(1000)
    assert seconds(60_000) < 1.5 + 20 * seconds(10_000)


def test_features_do_not_depend_on_the_texts_beside():
    texts = [t for t in [*STUFFED, *GENUINE] if t and t.strip()] + [p + sep.join(words * 20) for p, sep, words in KEYWORDS]
    lang, values = stuffed.features(texts)
    for i, t in enumerate(texts):
        own_lang, own = stuffed.features([t])
        assert own_lang[0] == lang[i] and {n: v[0] for n, v in own.items()} == {n: v[i] for n, v in values.items()}


def test_keywords_in_any_order_links_of_any_domain_and_other_languages(spark):
    rng = random.Random(3)
    en = "night bus ticket cheap fare metro map timetable coach pass online book station airport shuttle tram day discount rail travel deal price".split()
    de = "Nachtbus Fahrkarte günstig Tarif Fahrplan Haltestelle Flughafen Shuttle Tageskarte Rabatt Bahn Reise Angebot Preis Zug Monatskarte online buchen Auskunft".split()
    cases = [" ".join(rng.choice(en) for _ in range(n)) for n in (300, 80)] + [" ".join(rng.choice(de) for _ in range(300))]
    cases += ["\n".join(f"best-fares{i}.io" for i in range(80)), " ".join(f"ticket{i}.shop/buy" for i in range(80)), "[" + "a very long anchor " * 30 + "](https://x.example/y) \n" * 1]
    genuine = ["Tågen mellan stationerna är inställda på grund av ett signalfel och resenärer uppmanas att ta ersättningsbussen från torget istället. " * 3,
               "Mr. Smith arrived at St.Peter on time.The bus left e.g. at 7 a.m. and the driver waved." * 3, "[" * 50_000]
    df = spark.createDataFrame(list(enumerate([*cases, *genuine])), "doc_id int, text string")
    assert sorted(r.doc_id for r in stuffed.stuffed_pages(df, "doc_id", "text").collect()) == list(range(len(cases)))


def test_calibration_judges_by_the_rule_itself(spark):
    texts = ["https://www.host.example/" + "fares" * 40, "\n".join("Alpha Beta Gamma Delta Epsilon Zeta Eta Theta Iota Kappa".split()), PROSE * 3, STUFFED[0], None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id for r in stuffed.stuffed_pages(df, "doc_id", "text").collect()}
    labels = spark.createDataFrame([(i, int(i in found)) for i in range(5)], "doc_id int, stuffed int")
    rows = stuffed.calibration(df, labels, "doc_id", "text", "stuffed").collect()
    assert 0 in found and 1 not in found and (sum(r.hits for r in rows), sum(r.false_alarms for r in rows), sum(r.misses for r in rows), sum(r.n for r in rows)) == (len(found), 0, 0, 4)


def test_limits_move_only_where_the_labels_ask_for_it(spark):
    import pandas as pd

    clear = {n: 0.0 for n in stuffed.NAMES} | {"function_share": 0.3, "prose_share": 0.4, "page_lang": "en"}
    # in this language genuine pages recur a lot
    recurring = clear | {"page_lang": "fi", "ngram_share": 0.4, "stuffed_share": 0.6, "label": 0}
    rows = pd.DataFrame([clear | {"ngram_share": 0.5, "stuffed_share": 0.9, "prose_share": 0.1, "label": 1}, clear | {"ngram_share": 0.1, "label": 0}] * 20 + [recurring] * 20)
    fitted = stuffed.fit_limits(rows)
    assert set(fitted) == {"other", "fi"} and fitted["other"] == stuffed.LIMITS["other"] and set(fitted["fi"]) == {"ngram"} and 0.4 < fitted["fi"]["ngram"] <= 0.55
