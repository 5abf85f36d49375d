"""Text operators (F14-F29, S25 of the survey) as built-in expressions over strings and arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewell.functions.values import first_truthy

#: Words that open a question, and strings that bait clicks wherever they stand in a title.
QUESTION_WORDS = ("кто", "что", "где", "когда", "почему", "зачем", "как", "who", "what", "where", "when", "why", "how")
CLICKBAIT = ("шок", "срочно", "невероятно", "топ", "лучшие", "секрет", "удивит", "скандал", "честно", "разоблачение", "shocking", "urgent", "incredible", "top", "best", "secret", "you won't believe", "scandal", "honest", "exposed")
FILLERS = ("um", "uh", "like", "so", "well", "actually", "basically")
STOPWORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "de", "for", "from", "in", "is", "it", "la", "of", "on", "or", "que", "the", "to", "und", "was", "with")


def _c(x: Column | str) -> Column:
    return F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(""))


def squeeze(x: Column | str) -> Column:
    """White space as single spaces, ends trimmed."""
    return F.trim(F.regexp_replace(_c(x), r"\s+", " "))


def tokens(x: Column | str) -> Column:
    """Unicode words."""
    return F.regexp_extract_all(_c(x), F.lit(r"([\p{L}\p{N}_]+)"), 1)


def sentences(x: Column | str) -> Column:
    return F.filter(F.transform(F.split(_c(x), r"[.!?]+"), lambda s: F.trim(s)), lambda s: s != "")


def _share(n: Column, d: Column) -> Column:
    return F.coalesce(F.try_divide(n.cast("double"), d), F.lit(0.0))


def lexical_pack(df: DataFrame, text: str) -> DataFrame:
    """df with lengths, type-token ratio, punctuation, capitals, digits, question, links, mentions, readability."""
    t = F.col("_t")
    count = lambda p: F.regexp_count(t, F.lit(p))
    rows = df.withColumn("_t", squeeze(text)).withColumns({"_w": tokens(F.lower("_t")), "_s": F.greatest(F.size(sentences("_t")), F.lit(1))})
    n = F.size("_w")
    letters = F.length(F.array_join("_w", ""))
    chars = F.length(t)
    baits = sum((F.contains(F.lower(t), F.lit(w)).cast("int") for w in CLICKBAIT), F.lit(0))
    asks = F.coalesce(F.get("_w", F.lit(0)).isin(*QUESTION_WORDS) & F.startswith(F.lower(t), F.get("_w", F.lit(0))), F.lit(False)).cast("int")
    return rows.withColumns(
        {
            "n_chars_clean": chars, "n_words": n, "n_sentences": F.col("_s"), "n_unique": F.size(F.array_distinct("_w")),
            "type_token": _share(F.size(F.array_distinct("_w")), n), "mean_word": _share(letters, n), "words_per_sentence": _share(n, F.col("_s")),
            "punct_ratio": _share(count(r"[!-/:-@\[-`{-~]"), chars), "caps_ratio": _share(count("[A-Z]"), count("[A-Za-z]")), "digit_ratio": _share(count("[0-9]"), chars),
            "n_question": count(r"\?"), "n_exclaim": count("!"), "is_question": F.greatest(asks, t.endswith("?").cast("int")), "question_prefix": asks,
            "n_urls": count(r"https?://\S+"), "n_mentions": count(r"@[A-Za-z0-9_]+"), "n_numbers": count("[0-9]+"), "n_times": count("[0-9]{1,2}:[0-9]{2}"),
            "n_clickbait": baits, "clickbait_score": F.least(F.lit(1.0), (baits + (count("!") > 0).cast("int") + asks) / 3.0), "long_word_ratio": _share(F.regexp_count(F.lower(t), F.lit(r"[\p{L}\p{N}_]{7,}")), n),
            "special_ratio": _share(count(r"[^A-Za-z0-9\s]"), chars),
            "readability": 206.835 - 1.015 * _share(n, F.col("_s")) - 84.6 * _share(count("[aeiouyAEIOUY]+"), n),
        }
    ).drop("_t", "_w", "_s")


def hashtags(x: Column | str, longest: int = 64) -> Column:
    """Tags in order of first mention, lower case; longer ones left out (F16)."""
    found = F.regexp_extract_all(_c(x), F.lit(r"(?<![\p{L}\p{M}\p{N}_-])#([\p{L}\p{M}\p{N}][\p{L}\p{M}\p{N}_-]*)"), 1)
    return F.array_distinct(F.transform(F.filter(found, lambda w: F.length(w) <= longest), lambda w: F.lower(w)))


def without_hashtags(x: Column | str) -> Column:
    return squeeze(F.regexp_replace(_c(x), r"(?<![\p{L}\p{M}\p{N}_-])#[\p{L}\p{M}\p{N}][\p{L}\p{M}\p{N}_-]*", " "))


def canonical_tags(tags: Column | str, most: int = 30) -> Column:
    """Tags without #, trimmed, lower case, sorted, distinct, capped."""
    c = F.col(tags) if isinstance(tags, str) else tags
    clean = F.transform(c, lambda x: F.lower(F.trim(F.regexp_replace(x, "^#+", ""))))
    return F.slice(F.array_sort(F.array_distinct(F.filter(clean, lambda x: x != ""))), 1, most)


def questions(df: DataFrame, key: list[str], source: str, order: str, text: str, per_source: int, in_total: int) -> DataFrame:
    """Sentences that ask, equal ones once by first source, capped by source and in total."""
    part = df.select(*key, source, order, F.posexplode(F.split(_c(text), r"(?<=[.!?])\s+")).alias("_i", "question"))
    part = part.withColumn("question", squeeze("question")).withColumn("_k", F.lower(F.regexp_replace("question", r"[^\p{L}\p{N} ]", "")))
    first_word = F.regexp_extract("_k", r"^(\S+)", 1)
    part = part.where(F.col("question").endswith("?") | first_word.isin(*QUESTION_WORDS)).where("_k <> ''")
    seq = [F.col(source), F.col(order), F.col("_i")]
    once = part.withColumn("_r", F.row_number().over(Window.partitionBy(*key, "_k").orderBy(*seq))).where("_r = 1")
    capped = once.withColumn("_s", F.row_number().over(Window.partitionBy(*key, source).orderBy(order, "_i"))).where(F.col("_s") <= per_source)
    return capped.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy(*seq))).where(F.col("place") <= in_total).select(*key, source, "place", "question")


def _grams(n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size("_w") - n), lambda i: F.slice("_w", i + 1, n))


def keyphrases(df: DataFrame, key: list[str], text: str, top: int, longest: int = 3) -> DataFrame:
    """n-grams of 1 to 3 words by tf / (1 + first place) * length bonus, none beginning or ending in a stop word."""
    rows = df.select(*key, F.transform(tokens(text), lambda w: F.lower(w)).alias("_w"))
    grams = None
    for n in range(1, longest + 1):
        g = rows.where(F.size("_w") >= n).select(*key, F.lit(n).alias("n"), F.posexplode(_grams(n)).alias("at", "g"))
        grams = g if grams is None else grams.union(g)
    ok = ~F.get("g", F.lit(0)).isin(*STOPWORDS) & ~F.try_element_at("g", F.lit(-1)).isin(*STOPWORDS) & F.forall("g", lambda w: F.length(w) > 1)
    stats = grams.where(ok).groupBy(*key, "n", F.array_join("g", " ").alias("phrase")).agg(F.count("*").alias("tf"), F.min("at").alias("first"))
    scored = stats.withColumn("score", F.round(F.col("tf") / (1.0 + F.col("first")) * (1 + 0.25 * (F.col("n") - 1)), 9))
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score"), "phrase"))).where(F.col("rank") <= top).select(*key, "rank", "phrase", "score")


def speech_pack(df: DataFrame, text: str, seconds: Column) -> DataFrame:
    """Words a minute, characters a second, pauses, fillers and rare words of a transcript."""
    rows = df.withColumn("_w", F.transform(tokens(text), lambda w: F.lower(w)))
    n = F.size("_w")
    return rows.withColumns({"wpm": F.when(seconds > 0, n * 60.0 / seconds), "chars_per_second": F.when(seconds > 0, F.length(_c(text)) / seconds), "pause_density": _share(F.regexp_count(_c(text), F.lit(r"[,;:.!?]")), n), "filler_ratio": _share(F.size(F.filter("_w", lambda w: w.isin(*FILLERS))), n), "rare_ratio": _share(F.size(F.filter("_w", lambda w: F.length(w) > 9)), n)}).drop("_w")


def metadata_features(df: DataFrame, title: str) -> DataFrame:
    """Title length, words, question marks, share of capitals."""
    t = _c(title)
    return df.withColumns({"title_len": F.length(t), "title_words": F.size(F.filter(F.split(t, r"\s+"), lambda w: w != "")), "title_questions": F.regexp_count(t, F.lit(r"\?")), "title_upper": _share(F.regexp_count(t, F.lit("[A-Z]")), F.length(t))})


def select_turns(df: DataFrame, key: list[str], speaker: str, order: str, text: str, longest: int, least: int, per_speaker: int) -> DataFrame:
    """Trimmed and cut turn texts of enough length, equal ones once a speaker, capped."""
    rows = df.select(*key, speaker, order, F.substring(squeeze(text), 1, longest).alias("turn_text")).where(F.length("turn_text") >= least)
    once = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*key, speaker, F.lower("turn_text")).orderBy(order))).where("_r = 1")
    return once.withColumn("place", F.row_number().over(Window.partitionBy(*key, speaker).orderBy(order))).where(F.col("place") <= per_speaker).drop("_r")


def slim_captions(captions: Column | str) -> Column:
    """Caption map by primary language code, empty tracks out, the longest text on clashes."""
    c = F.col(captions) if isinstance(captions, str) else captions
    entries = F.filter(F.map_entries(c), lambda e: F.trim(F.coalesce(e["value"], F.lit(""))) != "")
    lang = lambda e: F.lower(F.regexp_extract(e["key"], "^([A-Za-z]+)", 1))
    ordered = F.array_sort(F.transform(entries, lambda e: F.struct(F.length(e["value"]).alias("n"), lang(e).alias("k"), e["value"].alias("v"))))
    return F.aggregate(ordered, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")), lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["k"]), F.map_from_arrays(F.array(e["k"]), F.array(e["v"]))))


def pad(values: Column | str, size: int, fill: Column) -> Column:
    """An array cut or filled to a size, and its mask."""
    v = F.coalesce(F.col(values) if isinstance(values, str) else values, F.array().cast("array<string>"))
    return F.slice(F.concat(v, F.array_repeat(fill, size)), 1, size)


def training_json(df: DataFrame, key: str, title: list[str], fields: list[str]) -> DataFrame:
    """Records shaped for training: the first truthy title, chosen fields, as JSON text."""
    return df.select(key, F.to_json(F.struct(F.struct(first_truthy(*title).alias("title"), *fields).alias("metadata"))).alias("record"))


def vtt_cues(payload: Column | str) -> Column:
    """Cue texts of a WebVTT payload: header, numbers and times out, tags out, repeated lines once."""
    lines = F.transform(F.split(_c(payload), r"\r?\n"), lambda x: F.trim(F.regexp_replace(x, "<[^>]*>", "")))
    return F.array_distinct(F.filter(lines, lambda x: (x != "") & ~x.rlike(r"^(WEBVTT.*|NOTE.*|\d+|.*-->.*)$")))


def json3_text(payload: Column | str) -> Column:
    """Text of a JSON3 caption payload: the segments of all events."""
    parsed = F.from_json(_c(payload), "events array<struct<segs: array<struct<utf8: string>>>>")
    return squeeze(F.array_join(F.transform(F.flatten(F.transform(F.filter(parsed["events"], lambda e: e["segs"].isNotNull()), lambda e: e["segs"])), lambda s: s["utf8"]), ""))


def xml_text(payload: Column | str) -> Column:
    """Text nodes of an XML caption payload."""
    return squeeze(F.array_join(F.xpath(_c(payload), F.lit("//text/text()")), " "))


def parse_subtitle(payload: str, ext: str) -> Column:
    """Dispatch by format."""
    return F.when(F.lower(ext) == "json3", json3_text(payload)).when(F.lower(ext).isin("xml", "srv1", "ttml"), xml_text(payload)).otherwise(F.array_join(vtt_cues(payload), " "))
