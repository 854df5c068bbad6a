"""Keyword-stuffed and link-list pages, by thresholds on repetition, links, separators and function words."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text whose tokens are counted together; it bounds memory and changes no result.
SLICE = 2_000_000
#: Frequent function words of the corpus' languages; Japanese is judged by its particles and endings instead.
FUNCTION_WORDS = {
    "en": "the a an of to in on at is was are were be been has have had it that this which and or but for from with by as not no if so than then they we you i he she his her its their our your will would can could should must may into after before until while because when where who about there did do does more all any each out up over between during",
    "de": "der die das den dem des ein eine einen einem einer eines und oder aber ist war sind waren wird werden wurde wurden hat haben hatte in im an am auf aus bei mit nach von vom zu zum zur für über unter um bis durch ohne gegen nicht kein keine sich es er sie wir ihr ich man dass ob als wie wenn weil so auch noch nur mehr seit wegen kurz laut ab",
    "fr": "le la les l un une des du de d au aux et ou mais est était sont étaient a ont avait en dans sur sous par pour avec sans ne pas plus que qui ce cette ces il elle ils elles on nous vous je se s sa son ses leur leurs y été à jusqu depuis après avant entre lors selon c n j moindre",
    "es": "el la los las un una unos unas de del al a y o pero es era son fueron fue ha han había en con sin por para que quien se su sus lo le les no más como cuando donde porque este esta estos estas hasta desde entre tras sobre según ya me mi nos muy cada poco",
    "fi": "ja tai mutta on oli ovat olivat ei eivät että kun jos niin se ne hän he me te minä joka jotka mikä mitä kuin vain myös jo vielä sekä kanssa ennen jälkeen aikana vuoksi takia noin asti klo sitten siitä tämä nämä ole ollut",
}
_LANGS = list(FUNCTION_WORDS)
#: Positions in ``_LANGS`` of the languages that have the word.
_OWNERS: dict[str, tuple[int, ...]] = {w: tuple(i for i, lang in enumerate(_LANGS) if w in set(FUNCTION_WORDS[lang].split())) for words in FUNCTION_WORDS.values() for w in words.split()}
#: A link: markdown, with a scheme, ``www.``, a host name of any top-level domain in small letters, or a footnote mark at a cell's end.
_LINK = re.compile(r"\[[^\[\]\n]*\]\([^)\s]*\)|https?://\S+|www\.\S+|(?<![\w@.-])[a-z0-9][\w-]+(?:\.[\w-]+)*\.[a-z]{2,}(?![\w-])(?:[/:?]\S*)?|\[\d{1,3}\](?=\s|$|\|)", re.ASCII)
#: What a link without a scheme, ``www.`` or brackets holds.
_MAYBE_HOST = re.compile(r"\.[a-z]{2}")
_TAG = re.compile(r"#\w+|\bsku-\w+")
_HIDDEN = re.compile("[\u200b-\u200f\u2060\ufeff\u00ad]")
_LEET_WORD = re.compile(r"(?<![\w@$])(?=[\w@$]*[a-z])(?=[\w@$]*[0134$@57])[a-z0-9@$]{3,}(?![\w@$])")
_LEET = str.maketrans("013457@$", "oieastas")
_MAYBE_LEET = re.compile(r"[a-z]\d[a-z]|\d[a-z]\d")
_CJK = re.compile("[\u3040-\u30ff\u3400-\u9fff]")
#: Tokens: data (clocks, decimals, deviations, leading numbers), words, and separators; in Japanese words are runs of katakana and single other characters.
_DATUM = r"(?<!\d)\d{1,2}[:h][0-5]\d(?!\d)|\d+[.,]\d+|[+-]\d+ s\b|^[^\S\n]*\d{1,2}[.)](?=\s)"
_SEPARATOR = r"[\n|•·;,、。»→/!?！？]+|(?<=[^\W\d])\.(?=\s|$)|\s[-–—](?=\s)"
_TOKEN = re.compile(rf"[^\W\d_][^\W_]*|{_DATUM}|[^\W_]+|{_SEPARATOR}", re.MULTILINE)
_EAST = re.compile(rf"{_DATUM}|[\u30a0-\u30ff]+|[\u3040-\u309f\u3400-\u9fff]|[^\W_\u3040-\u30ff\u3400-\u9fff]+|{_SEPARATOR}", re.MULTILINE)
_IS_DATUM = re.compile(r"\d{1,2}[:h][0-5]\d$|\d+[.,]\d+$|[+-]\d+ s$|\s*\d{1,2}[.)]$")
_IS_WORD = re.compile(r"[^\W_]+$")
_PARTICLES = frozenset("はがをにでもへやとのたすいるてなりれま")


def plain(text: str) -> tuple[str, int, int]:
    """A text in lower case under NFKC, without invisible characters, links and tags, in whose place ``|`` stands, digits and signs inside words read as the
    letters they stand for; the characters of its links and tags, and their number."""
    t = text if text.isascii() else _HIDDEN.sub("", unicodedata.normalize("NFKC", text))
    found: list[str] = []

    def cut(m: re.Match[str]) -> str:
        found.append(m[0])
        return " | "

    if "://" in t or "www." in t or "[" in t or _MAYBE_HOST.search(t):
        t = _LINK.sub(cut, t)
    t = t.lower()
    if "#" in t or "sku-" in t:
        t = _TAG.sub(cut, t)
    if "@" in t or "$" in t or _MAYBE_LEET.search(t):
        t = _LEET_WORD.sub(lambda m: m[0].translate(_LEET) if 3 * sum(c.isalpha() for c in m[0]) >= len(m[0]) else m[0], t)
    return t, sum(len(m) - m.count(" ") for m in found), len(found)


#: What a unit is made of. Word pairs and words recur from OFTEN times on, or from OFTEN_SHARE of the words of a long text. A unit is stuffed if RECURRING of its
#: pairs recur and its function words stay below MOST_FUNCTION (by its words, or for Japanese by its characters), if it is a short one (SHORT_UNIT words) that stands REPEATED times, or a
#: long one that does so with hardly any function word (HARDLY), or a run of at least SHORT_UNIT words of which COMMON recur without function words (NONE).
OFTEN, OFTEN_SHARE = 3, 0.004
RECURRING, COMMON, REPEATED, SHORT_UNIT = 0.4, 0.6, 4, 8
MOST_FUNCTION = {"ja": 0.15, "short": 0.3, "long": 0.2}
HARDLY, NONE = 0.1, 0.05
#: Function words of prose: their share of a unit's words, or of its characters in Japanese, from units of FEWEST_WORDS on; bare units have at most BARE_WORDS.
PROSE, PROSE_EAST, FEWEST_WORDS, BARE_WORDS, BARE_FUNCTION = 0.2, 0.25, 4, 7, 0.3

NAMES = ("n_chars", "function_share", "top_word_share", "ngram_share", "duplicate_share", "link_share", "separator_density", "datum_share", "stuffed_share", "prose_share", "bare_share", "n_links", "n_units")
LANGUAGES = [*_LANGS, "ja", "und"]
#: Multiplier of the rolling hash that names a unit by its words.
_ROLL = np.uint64(0x9E3779B97F4A7C15)


def _counts(*parts: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    """Of each row, how many rows (or how much weight) agree with it in all parts, by a 64-bit hash of them."""
    key = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        key = (key ^ part.astype(np.uint64)) * _ROLL
        key ^= key >> np.uint64(29)
    codes, _ = pd.factorize(key)
    return np.bincount(codes, weights=weight)[codes] if len(codes) else np.zeros(0)


def features(texts: list[str]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Language (index into :data:`LANGUAGES`) by function words and the features :data:`NAMES` of whole texts, none of them null, empty or blank.

    Each text is cut into tokens once; all counting runs over the tokens of all texts together, as arrays. Shares are of the
    characters of words, links and tags, except those of words and n-grams. A text falls into links, tags and units between separators: units
    with a clock, a decimal or a leading number (``datum_share``), units repeated often, whose word pairs recur throughout the text
    or whose words do, without function words (``stuffed_share``), units with function words (``prose_share``) and other short units
    without them (``bare_share``). A line of data without sentences is one unit. Repeats of units of more than eight words count
    once in pairs and words, as whole sentences are repeated in genuine notices too.
    """
    n_docs = len(texts)
    linked, some, tokens, lens = np.zeros(n_docs), np.zeros(n_docs), [], np.zeros(n_docs, np.int64)
    for i, text in enumerate(texts):
        t, linked[i], some[i] = plain(text)
        found = (_TOKEN if t.isascii() or not _CJK.search(t) else _EAST).findall(t)
        lens[i] = len(found)
        tokens += found
    codes, uniques = pd.factorize(np.array(tokens, dtype=object)) if tokens else (np.zeros(0, np.int64), np.zeros(0, object))
    word = np.array([_IS_WORD.match(u) is not None for u in uniques], bool)
    datum_of = np.array([not w and _IS_DATUM.match(u) is not None for u, w in zip(uniques, word, strict=True)], bool)
    newline_of = np.array([not w and not d and "\n" in u for u, w, d in zip(uniques, word, datum_of, strict=True)], bool)
    stop_of = np.array([not w and u[0] in ".。!?！？" for u, w in zip(uniques, word, strict=True)], bool)
    size_of = np.array([len(u.strip()) for u in uniques], np.float64)
    owner_of = np.zeros((len(_LANGS), len(uniques)), bool)
    for j, u in enumerate(uniques):
        for i in _OWNERS.get(u, ()):
            owner_of[i, j] = True
    east_of = np.array([_CJK.match(u) is not None for u in uniques], bool)
    particle_of = np.array([u in _PARTICLES for u in uniques], bool)

    # lines and units
    doc = np.repeat(np.arange(n_docs), lens)
    starts = np.ones(len(doc), bool)
    starts[1:] = doc[1:] != doc[:-1]
    newline = newline_of[codes]
    line = np.cumsum(starts | newline) - 1
    separator = ~(word | datum_of)[codes]
    last = np.ones(len(doc), bool)
    last[:-1] = starts[1:] | newline[1:]
    n_lines = int(line[-1]) + 1 if len(line) else 0
    data = (np.bincount(line, weights=datum_of[codes], minlength=n_lines) > 0) & (np.bincount(line, weights=stop_of[codes] & ~last, minlength=n_lines) == 0)
    separator &= newline | ~data[line]
    unit = np.cumsum(starts | separator) - 1
    separators = np.bincount(doc, weights=separator, minlength=n_docs)
    keep = (word | datum_of)[codes]
    w, d, u = codes[keep], doc[keep], unit[keep]
    first = np.ones(len(u), bool)
    first[1:] = u[1:] != u[:-1]
    at = np.flatnonzero(first)
    n_units = len(at)
    k = np.cumsum(first) - 1
    sums = lambda x: np.bincount(k, weights=x, minlength=n_units)
    length, size, of = sums(None), sums(size_of[w]), d[at]
    is_datum = sums(datum_of[w]) > 0
    place = np.arange(len(u)) - at[k] if len(u) else np.zeros(0, np.int64)
    powers = np.cumprod(np.full(int(place.max()) + 1 if len(u) else 1, _ROLL, np.uint64))
    name = np.add.reduceat((w.astype(np.uint64) + np.uint64(1)) * powers[place], at) if n_units else np.zeros(0, np.uint64)
    whole = _counts(of, name, length)
    again = np.zeros(n_units, bool)
    if n_units:
        again = pd.DataFrame({"d": of, "n": name, "l": length}).duplicated().to_numpy()
    once = np.where((again & (length > SHORT_UNIT))[k], 0.0, 1.0) if n_units else np.zeros(0)

    # words and pairs
    total_words = np.maximum(1, np.bincount(d, minlength=n_docs))
    often = np.maximum(OFTEN, OFTEN_SHARE * total_words)
    single = _counts(d, w, weight=once)
    top = np.zeros(n_docs)
    if len(d):
        begin = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        top[d[begin]] = np.maximum.reduceat(_counts(d, w), begin)
    inner = np.flatnonzero(~first)
    pair = _counts(d[inner], w[inner - 1], w[inner], weight=once[inner])
    recurs = pair >= often[d[inner]]
    alone = (length == 1)[k] if n_units else np.zeros(0, bool)
    grams = np.bincount(d[inner], weights=once[inner], minlength=n_docs) + np.bincount(d, weights=alone, minlength=n_docs)
    recurrent = np.bincount(d[inner], weights=recurs * once[inner], minlength=n_docs) + np.bincount(d, weights=alone & (single >= often[d]), minlength=n_docs)
    recurring = np.where(length > 1, np.bincount(k[inner], weights=recurs, minlength=n_units) / np.maximum(1, length - 1), sums(single >= often[d]))
    common = sums(single >= often[d]) / np.maximum(1, length)

    # languages and function words
    by_unit = np.stack([sums(owner_of[i][w]) for i in range(len(_LANGS))]) if n_units else np.zeros((len(_LANGS), 0))
    hits = np.stack([np.bincount(of, weights=x, minlength=n_docs) for x in by_unit])
    cjk, kana = sums(east_of[w] * size_of[w]), sums(particle_of[w])
    chars, east = np.bincount(of, weights=size, minlength=n_docs), np.bincount(of, weights=cjk, minlength=n_docs)
    lang = np.where(hits.max(0) > 0, hits.argmax(0), LANGUAGES.index("und"))
    lang = np.where(east > 0.3 * np.maximum(1, chars), LANGUAGES.index("ja"), lang)
    known = sums(owner_of.any(0)[w])
    functional = np.where(cjk > 0, kana / np.maximum(1, cjk), np.where((lang < len(_LANGS))[of], by_unit.max(0), known) / np.maximum(1, length)) if n_units else np.zeros(0)
    full = np.where(cjk > 0, functional >= PROSE_EAST, (functional >= PROSE) & (length >= FEWEST_WORDS))
    own = hits[np.minimum(lang, len(_LANGS) - 1), np.arange(n_docs)] / total_words
    function = np.where(lang == LANGUAGES.index("ja"), np.bincount(of, weights=kana, minlength=n_docs) / np.maximum(1, east), np.where(lang < len(_LANGS), own, 0))

    # what each unit is
    limit = np.where(cjk > 0, MOST_FUNCTION["ja"], np.where(length < 10, MOST_FUNCTION["short"], MOST_FUNCTION["long"]))
    repeated = (whole >= REPEATED) & np.where(length <= SHORT_UNIT, ~(full & (length > FEWEST_WORDS + 1)), functional < HARDLY)
    run = (length >= SHORT_UNIT) & (functional < NONE) & (common >= COMMON) & (cjk == 0)
    stuffed = ~is_datum & (repeated | (recurring >= RECURRING) & (functional < limit) | run)
    prose = ~is_datum & ~stuffed & full
    bare = ~is_datum & ~stuffed & ~full & (functional < BARE_FUNCTION) & (length <= BARE_WORDS)
    part = lambda x: np.bincount(of, weights=size * x, minlength=n_docs)
    total = np.maximum(1, chars + linked)
    values = [np.array([float(len(t)) for t in texts]), function, top / total_words, recurrent / np.maximum(1, grams), part(whole > 1) / total, linked / total, separators / total,
              part(is_datum) / total, part(stuffed) / total, part(prose) / total, part(bare) / total, some, np.bincount(of, minlength=n_docs).astype(float)]
    return lang, dict(zip(NAMES, values, strict=True))


#: Limits by language that :func:`fit_limits` gave on the labelled rows of the small tables whose id is even; ``other`` holds its start, which it
#: keeps for languages without a reason to move. ``ngram``: least share of recurring n-grams (word pairs, and units of one word). ``top``: least share of the most frequent word, where
#: function words are rarer than FUNCTION_LIMIT, as the most frequent word of prose is one of them. ``duplicate``: least share of repeated units, where
#: separators are at least as dense as SEPARATOR_LIMIT, as paragraphs repeat too. ``missing``: function words rarer than this are missing, and keywords
#: then need neither recur in order nor prevail.
LIMITS = {
    "other": {"ngram": 0.25, "top": 0.15, "duplicate": 0.4, "missing": 0.1},
    "fi": {"ngram": 0.55, "missing": 0.03},
}
FUNCTION_LIMIT = 0.2
SEPARATOR_LIMIT = 0.04
#: Least number of links and tags that make a link list, whose short bare units then count as its captions.
LIST_LINKS = 3
#: Share of the characters that stuffed material must reach, and the share from which :func:`fit_limits` keeps genuine pages away from a limit.
GREATER_PART, NEAR = 0.5, 0.4


def with_features(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``page_lang`` and the features of every row with text; null, empty and blank texts give no row. No shuffle."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            begin = 0
            while begin < len(texts):
                # slices of bounded size, so that long texts do not add up in memory; a text is never cut
                end, held = begin, 0
                while end < len(texts) and (end == begin or held < SLICE):
                    held += len(texts[end] or "")
                    end += 1
                keep = [i for i in range(begin, end) if texts[i] and not texts[i].isspace()]
                if keep:
                    lang, values = features([texts[i] for i in keep])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array([LANGUAGES[x] for x in lang], pa.string()), *[pa.array(values[n], pa.float64()) for n in NAMES]], [key, "page_lang", *NAMES])
                begin = end

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, page_lang string, " + ", ".join(f"{n} double" for n in NAMES))


def limits_of(lang: str, limits: dict[str, dict[str, float]] = LIMITS) -> dict[str, float]:
    return limits["other"] | limits.get(lang, {})


#: The decision over the features and the four limits of the page's language (``<name>_limit``), as SQL that Spark and DuckDB both read.
#: Links and tags count if they form a list or nearly the whole text, so sentences followed by some links are no case. Repeated
#: units count if n-grams recur, one word prevails, units repeat or function words are missing as much as the language's limits ask. Bare units
#: count within lists of links or tags, and within keyword pages without prose. All of it must make up the greater part, and outweigh prose and data.
CONDITIONS = {
    "ngram": "ngram_share >= ngram_limit",
    "top": f"top_word_share >= top_limit AND function_share < {FUNCTION_LIMIT}",
    "duplicate": f"duplicate_share >= duplicate_limit AND separator_density >= {SEPARATOR_LIMIT}",
    "missing": "function_share < missing_limit",
}
_OPEN = "(" + " OR ".join(CONDITIONS.values()) + ")"
_SHARE = f"""(CASE WHEN n_links >= {LIST_LINKS} OR link_share >= 0.85 THEN link_share ELSE 0 END
 + CASE WHEN n_links >= {LIST_LINKS} OR {_OPEN} THEN stuffed_share ELSE 0 END
 + CASE WHEN n_links >= {LIST_LINKS} OR {_OPEN} AND stuffed_share >= 0.3 AND prose_share < 0.15 THEN bare_share ELSE 0 END)"""
RULE = f"({_SHARE} >= {GREATER_PART} AND {_SHARE} > prose_share + datum_share)"


def with_limits(features_: DataFrame, limits: dict[str, dict[str, float]] = LIMITS) -> DataFrame:
    """Rows of :func:`with_features` with the limits of their language."""
    def of(name: str) -> F.Column:
        return F.try_element_at(F.create_map(*[F.lit(x) for lang in LANGUAGES for x in (lang, limits_of(lang, limits)[name])]), F.col("page_lang"))

    return features_.withColumns({f"{n}_limit": of(n) for n in limits["other"]})


def stuffed_pages(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` of every page that consists for the greater part of keywords, links or product tags. One narrow pass over whole texts."""
    return with_limits(with_features(df, key, text)).where(RULE).select(key)


def judged(df: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """The labelled rows with text: ``key``, ``label``, features, limits and ``case``, the decision of :func:`stuffed_pages` itself."""
    known = labels.select(F.col(key).alias("__key"), F.col(label).alias("__label")).distinct()
    rows = df.join(known, df[key] == F.col("__key"), "left_semi")
    return with_limits(with_features(rows, key, text)).join(known, F.col(key) == F.col("__key")).drop("__key").withColumnRenamed("__label", "label").withColumn("case", F.expr(RULE))


def fit_limits(rows: pd.DataFrame, start: dict[str, float] = LIMITS["other"], least: int = 20) -> dict[str, dict[str, float]]:
    """Limits per language from labelled rows (``page_lang``, ``label`` and the features), a bounded sample held in memory.

    Language by language, each limit in turn is tried at every twentieth (``missing`` at every hundredth) with the others as they are. It moves
    from ``start`` only where that leaves fewer wrong rows, or as many and fewer genuine rows that pass its own condition and
    are stuffed for at least NEAR of the page, were all conditions met; then one step past the nearest best value, if that is as good. Languages of fewer than ``least`` rows keep ``start``.
    """
    import duckdb

    con = duckdb.connect(":memory:", config={"threads": 1})
    out = {"other": dict(start)}
    whole = _SHARE.replace(_OPEN, "true")
    for lang, part in rows.groupby("page_lang"):
        if len(part) < least:
            continue
        con.register("part", part.reset_index(drop=True))
        now = dict(start)

        def cost(name: str, x: float, now: dict[str, float] = now) -> tuple[int, int]:
            given = ", ".join(f"{v} AS {n}_limit" for n, v in (now | {name: x}).items())
            return con.execute(f"SELECT count(*) FILTER (WHERE {RULE} <> (label = 1)), count(*) FILTER (WHERE {CONDITIONS[name]} AND label = 0 AND {whole} >= {NEAR}) FROM (SELECT *, {given} FROM part)").fetchall()[0]

        for name in CONDITIONS:
            steps = [i / 100 for i in range(21)] if name == "missing" else [i / 20 for i in range(18)]
            tried = sorted((cost(name, x), abs(x - start[name]), x) for x in steps)
            if tried[0][0] < cost(name, start[name]):
                now[name] = tried[1][2] if tried[1][0] == tried[0][0] else tried[0][2]
        if moved := {n: v for n, v in now.items() if v != start[n]}:
            out[str(lang)] = moved
        con.unregister("part")
    con.close()
    return out


def calibration(df: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """Hits, false alarms and misses of :func:`stuffed_pages` per language, apart for the rows the limits were fitted on (even ``key``) and the rest."""
    rows = judged(df, labels, key, text, label).withColumn("held_out", F.pmod(F.col(key), F.lit(2)) == 1)
    return rows.groupBy("page_lang", "held_out").agg(F.count_if(F.col("case") & (F.col("label") == 1)).alias("hits"), F.count_if(F.col("case") & (F.col("label") == 0)).alias("false_alarms"),
                                                     F.count_if(~F.col("case") & (F.col("label") == 1)).alias("misses"), F.count(F.lit(1)).alias("n"))
