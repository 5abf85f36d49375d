"""Queries of the text operators over documents, conversations and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.functions import values as V
from framewell.operators import textual as X
from framewell.plans.common import table


def f07_lenient(spark, sf):
    raw = F.when(F.col("c_custkey") % 5 == 0, F.lit("n/a")).when(F.col("c_custkey") % 5 == 1, F.concat(F.lit(" "), F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(",")))).when(F.col("c_custkey") % 5 == 2, F.lit("1 234,5")).when(F.col("c_custkey") % 5 == 3, "abc").otherwise(F.col("c_custkey").cast("string"))
    return table(spark, sf, "customer").select("c_custkey", V.lenient_double(raw).alias("d"), V.lenient_bigint(raw).alias("i"), V.empty_like(raw).alias("empty"))


def f01_log_target(spark, sf):
    o = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min("l_quantity").alias("v0"), F.max(F.when(F.col("l_linenumber") == 2, F.col("l_extendedprice") / 100)).alias("v7"))
    return o.select("l_orderkey", F.round(V.log1p_delta("v7", "v0"), 6).alias("target"), F.round(V.log1p_delta("v7", "v0", True), 6).alias("target_int"), V.finite("v7").isNotNull().alias("mask"))


def f02_video_targets(spark, sf):
    e = table(spark, sf, "events").where("user_id IS NOT NULL")
    from pyspark.sql.window import Window

    i = e.withColumn("i", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1).where("i < 4")
    wide = i.groupBy("user_id").pivot("i", [0, 1, 2, 3]).agg(F.max("value")).toDF("user_id", "s0", "s1", "s2", "s3")
    return wide.select("user_id", *(F.round(V.log1p_delta(f"s{h}", "s0"), 6).alias(f"target_{d}") for h, d in ((1, "7d"), (2, "14d"), (3, "21d"))), *((V.finite(f"s{h}").isNotNull() & V.finite("s0").isNotNull()).cast("int").alias(f"mask_{d}") for h, d in ((1, "7d"), (2, "14d"), (3, "21d"))))


def f03_ratio(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(V.safe_ratio("l_extendedprice", F.col("l_linenumber") - 3), 6).alias("ratio"), V.close("l_quantity", F.col("l_quantity") + F.col("l_linenumber") * 0.002).alias("close"))


def f05_softmax(spark, sf):
    from pyspark.sql.window import Window

    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(V.softmax_over(F.col("l_quantity"), Window.partitionBy("l_orderkey"), 10.0), 7).alias("p"))


def f09_times(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy_MM_dd_HH_mm").alias("a"), F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("o_orderkey") % 2 == 0, "Z").otherwise("+03:00")).alias("b"))
    return o.select("o_orderkey", V.parse_stamp("a").cast("string").alias("stamp"), V.parse_iso("b").cast("string").alias("iso"), F.round(V.age_hours(V.parse_iso("b"), V.parse_stamp("a")), 6).alias("age"), F.round(V.age_hours(V.parse_iso("b"), V.parse_stamp("a"), False), 6).alias("signed"))


def f12_schedule(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("base"), F.posexplode(F.array(F.lit(0), F.lit(168), F.lit(336), F.lit(504))).alias("i", "hours")).where("i > 0")
    due = F.expr("base + make_interval(0, 0, 0, 0, hours)")
    return o.select("o_orderkey", "i", due.cast("string").alias("due"), F.expr("base + make_interval(0, 0, 0, 0, hours + 5 + 168)").cast("string").alias("next_due"))


def f14_tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.length(X.squeeze("text")).alias("clean_len"), F.size(X.tokens("text")).alias("n_tokens"), F.size(X.sentences("text")).alias("n_sentences"))


def f15_lexical(spark, sf):
    cols = ["n_words", "n_unique", "type_token", "mean_word", "punct_ratio", "caps_ratio", "digit_ratio", "n_question", "is_question", "n_urls", "n_mentions", "n_numbers", "n_clickbait", "question_prefix", "clickbait_score", "long_word_ratio"]
    out = X.lexical_pack(table(spark, sf, "documents").select("doc_id", "text"), "text")
    return out.select("doc_id", *(F.round(c, 7).alias(c) if c.endswith(("ratio", "token", "word", "score")) else F.col(c).cast("bigint").alias(c) for c in cols))


def f16_hashtags(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.concat_ws(" ", F.lit("#Top"), F.regexp_replace("text", " ([a-z]{5,9}) ", " #$1 ")).alias("t"))
    return d.select("doc_id", F.array_join(X.hashtags("t", 12), ",").alias("tags"), F.length(X.without_hashtags("t")).alias("rest"))


def f17_tags(spark, sf):
    return f17_tags_all(spark, sf)


def f17_tags_all(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("tags"))
    return d.select("doc_id", F.array_join(X.canonical_tags("tags", 8), "|").alias("tags"))


def f18_questions(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "role", "turn", F.regexp_replace("text", r"\. ", "? ").alias("text"))
    return X.questions(c, ["conv_id"], "role", "turn", "text", 3, 5)


def f19_keyphrases(spark, sf):
    return X.keyphrases(table(spark, sf, "benchmark").select("item_id", "text"), ["item_id"], "text", 5)


def f20_speech(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    out = X.speech_pack(c, "text", F.col("turn") * 4.0)
    return out.select("conv_id", "turn", *(F.round(x, 6).alias(x) for x in ("wpm", "chars_per_second", "pause_density", "filler_ratio", "rare_ratio")))


def f21_metadata(spark, sf):
    out = X.metadata_features(table(spark, sf, "conversations").select("conv_id", "turn", "text"), "text")
    return out.select("conv_id", "turn", "title_len", "title_words", "title_questions", F.round("title_upper", 7).alias("title_upper"))


def f22_turns(spark, sf):
    return X.select_turns(table(spark, sf, "conversations"), ["conv_id"], "role", "turn", "text", 60, 20, 3).select("conv_id", "role", "turn", "turn_text", "place")


def f23_captions(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.create_map(F.lit("en-US"), F.col("c_name"), F.lit("en"), F.col("c_mktsegment"), F.lit("DE"), F.when(F.col("c_custkey") % 2 == 0, "hallo"), F.lit("fr"), F.lit(" ")).alias("m"))
    m = c.withColumn("m", X.slim_captions("m"))
    return m.select("c_custkey", F.try_element_at("m", F.lit("en")).alias("en"), F.try_element_at("m", F.lit("de")).alias("de"), F.size("m").alias("n"))


def f24_channel(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", V.channel_key(F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey").cast("string")), F.when(F.col("c_custkey") % 3 == 1, F.col("c_name")), F.col("c_custkey").cast("string")).alias("channel"))


def f25_slots(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", V.sha_slot("c_name", 7).alias("slot"), F.round(V.unit_hash("c_name"), 9).alias("unit"))


def f28_pad(spark, sf):
    d = table(spark, sf, "benchmark").select("item_id", F.split("text", " ").alias("w"))
    return d.select("item_id", F.array_join(X.pad("w", 20, F.lit("_")), " ").alias("padded"), F.least(F.size("w"), F.lit(20)).alias("mask"))


def f29_training_json(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("title"), F.col("o_orderstatus").alias("name"), "o_custkey")
    return X.training_json(o, "o_orderkey", ["title", "name"], ["o_custkey"])


def f30_first_of(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", V.first_truthy(F.col("event_id") % 3, F.col("event_id") % 5, F.lit(-1)).cast("bigint").alias("v"))


_W = "list_transform(regexp_extract_all(regexp_replace(trim(regexp_replace(coalesce(text,''),'\\s+',' ','g')),'','','g'), '[\\p{L}\\p{N}_]+'), lambda w: lower(w))"
_T = "trim(regexp_replace(coalesce(text,''),'\\s+',' ','g'))"
_N = lambda p: f"len(regexp_extract_all(t,'{p}'))"
_BAITS = "+".join("contains(lower(t),'" + w.replace("'", "''") + "')::INT" for w in X.CLICKBAIT)
QUERIES = {
    "f01_log_target": (f01_log_target, "WITH o AS (SELECT l_orderkey, min(l_quantity) v0, max(l_extendedprice/100) FILTER (l_linenumber=2) v7 FROM lineitem GROUP BY 1) SELECT l_orderkey, CASE WHEN v7 IS NOT NULL THEN round(ln(1+greatest(v7-v0,0)),6) END target, CASE WHEN v7 IS NOT NULL THEN round(ln(1+greatest(trunc(v7)-trunc(v0),0)),6) END target_int, v7 IS NOT NULL mask FROM o"),
    "f02_video_targets": (f02_video_targets, "WITH i AS (SELECT user_id, value v, row_number() OVER (PARTITION BY user_id ORDER BY event_id)-1 i FROM events WHERE user_id IS NOT NULL), w AS (SELECT user_id, max(v) FILTER (i=0) a, max(v) FILTER (i=1) b, max(v) FILTER (i=2) c, max(v) FILTER (i=3) d FROM i WHERE i<4 GROUP BY 1) SELECT user_id, " + ", ".join(f"CASE WHEN {x} IS NOT NULL AND a IS NOT NULL THEN round(ln(1+greatest({x}-a,0)),6) END target_{h}, ({x} IS NOT NULL AND a IS NOT NULL)::INT mask_{h}" for x, h in (("b", "7d"), ("c", "14d"), ("d", "21d"))) + " FROM w"),
    "f03_ratio": (f03_ratio, "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber>3 THEN round(l_extendedprice/(l_linenumber-3),6) END ratio, abs(l_quantity-(l_quantity+l_linenumber*0.002))<=1e-5+1e-4*abs(l_quantity+l_linenumber*0.002) AS close FROM lineitem"),
    "f05_softmax": (f05_softmax, "WITH e AS (SELECT l_orderkey, l_linenumber, exp((l_quantity-max(l_quantity) OVER (PARTITION BY l_orderkey))/10.0) e FROM lineitem) SELECT l_orderkey, l_linenumber, round(e/sum(e) OVER (PARTITION BY l_orderkey),7) p FROM e"),
    "f07_lenient": (f07_lenient, "SELECT c_custkey, CASE c_custkey%5 WHEN 1 THEN c_acctbal WHEN 2 THEN 1234.5 WHEN 4 THEN c_custkey::DOUBLE END d, CASE WHEN c_custkey%5=4 THEN c_custkey END i, c_custkey%5=0 AS empty FROM customer"),
    "f09_times": (f09_times, "WITH o AS (SELECT o_orderkey, date_trunc('minute',o_orderdate) a, date_trunc('second',o_orderdate)-CASE WHEN o_orderkey%2=0 THEN INTERVAL 0 HOUR ELSE INTERVAL 3 HOUR END b FROM orders) SELECT o_orderkey, strftime(a,'%Y-%m-%d %H:%M:%S') stamp, strftime(b,'%Y-%m-%d %H:%M:%S') iso, round(greatest(epoch(b-a)/3600,0),6)::DOUBLE age, round(epoch(b-a)/3600,6)::DOUBLE signed FROM o"),
    "f12_schedule": (f12_schedule, "WITH o AS (SELECT o_orderkey, o_orderdate b, unnest([1,2,3]) i FROM orders) SELECT o_orderkey, i, strftime(b+to_hours(168*i),'%Y-%m-%d %H:%M:%S') due, strftime(b+to_hours(168*i+173),'%Y-%m-%d %H:%M:%S') next_due FROM o"),
    "f14_tokens": (f14_tokens, f"SELECT doc_id, length({_T}) clean_len, len(regexp_extract_all(coalesce(text,''),'[\\p{{L}}\\p{{N}}_]+')) n_tokens, len(list_filter(list_transform(string_split_regex(coalesce(text,''),'[.!?]+'), lambda s: trim(s)), lambda s: s<>'')) n_sentences FROM documents"),
    "f15_lexical": (f15_lexical, f"WITH t AS (SELECT doc_id, {_T} t FROM documents), w AS (SELECT doc_id, t, list_transform(regexp_extract_all(t,'[\\p{{L}}\\p{{N}}_]+'), lambda x: lower(x)) w FROM t), n AS (SELECT *, len(w) n, nullif(length(t),0) c, coalesce(w[1] IN ({', '.join(repr(x) for x in X.QUESTION_WORDS)}) AND starts_with(lower(t), w[1]),false) q, {_BAITS} b FROM w) SELECT doc_id, n::BIGINT n_words, len(list_distinct(w))::BIGINT n_unique, round(coalesce(len(list_distinct(w))/nullif(n,0),0),7) type_token, round(coalesce(list_sum(list_transform(w, lambda x: length(x)))/nullif(n,0),0),7) mean_word, round(coalesce({_N('[!-/:-@\\[-`{-~]')}/c,0),7) punct_ratio, round(coalesce({_N('[A-Z]')}/nullif({_N('[A-Za-z]')},0),0),7) caps_ratio, round(coalesce({_N('[0-9]')}/c,0),7) digit_ratio, {_N('\\?')}::BIGINT n_question, (q OR ends_with(t,'?'))::BIGINT is_question, q::BIGINT question_prefix, round(least(1.0::DOUBLE,(b+(contains(t,'!'))::INT+q::INT)/3.0::DOUBLE),7) clickbait_score, {_N('https?://\\S+')}::BIGINT n_urls, {_N('@[A-Za-z0-9_]+')}::BIGINT n_mentions, {_N('[0-9]+')}::BIGINT n_numbers, b::BIGINT n_clickbait, round(coalesce(len(list_filter(w, lambda x: length(x)>6))/nullif(n,0),0),7) long_word_ratio FROM n"),
    "f16_hashtags": (f16_hashtags, r"""WITH d AS (SELECT doc_id, concat_ws(' ', '#Top', regexp_replace(text,' ([a-z]{5,9}) ',' #\1 ','g')) t FROM documents), h AS (SELECT *, list_transform(list_filter(regexp_extract_all(t,'(?:^|[^\p{L}\p{M}\p{N}_-])#([\p{L}\p{M}\p{N}][\p{L}\p{M}\p{N}_-]*)',1), lambda x: length(x)<=12), lambda x: lower(x)) h FROM d)
      SELECT doc_id, array_to_string(list_filter(h, lambda x, i: list_position(h,x)=i),',') tags, length(trim(regexp_replace(regexp_replace(t,'(^|[^\p{L}\p{M}\p{N}_-])#[\p{L}\p{M}\p{N}][\p{L}\p{M}\p{N}_-]*','\1 ','g'),'\s+',' ','g'))) rest FROM h"""),
    "f17_tags": (f17_tags, "SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(text,' '), lambda x: lower(trim(regexp_replace(x,'^#+','')))), lambda x: x<>'')))[1:8],'|') tags FROM documents"),
    "f17_tags_all": (f17_tags_all, None),
    "f18_questions": (f18_questions, None),
    "f19_keyphrases": (f19_keyphrases, f"WITH w AS (SELECT item_id, list_transform(regexp_extract_all(coalesce(text,''),'[\\p{{L}}\\p{{N}}_]+'), lambda x: lower(x)) w FROM benchmark), g AS (SELECT item_id, n, unnest(range(len(w)-n+1)) a, w FROM w, (SELECT unnest([1,2,3]) n)), p AS (SELECT item_id, n, a, w[a+1:a+n] g FROM g), k AS (SELECT item_id, n, array_to_string(g,' ') phrase, count(*) tf, min(a) f FROM p WHERE g[1] NOT IN ({', '.join(repr(x) for x in X.STOPWORDS)}) AND g[-1] NOT IN ({', '.join(repr(x) for x in X.STOPWORDS)}) AND len(list_filter(g, lambda x: length(x)<=1))=0 GROUP BY ALL), s AS (SELECT item_id, phrase, round(tf/(1.0+f)*(1+0.25*(n-1)),9)::DOUBLE score FROM k) SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, phrase)::INT \"rank\", phrase, score FROM s QUALIFY \"rank\"<=5"),
    "f20_speech": (f20_speech, f"WITH w AS (SELECT conv_id, turn, coalesce(text,'') t, list_transform(regexp_extract_all(coalesce(text,''),'[\\p{{L}}\\p{{N}}_]+'), lambda x: lower(x)) w, turn*4.0 s FROM conversations), n AS (SELECT *, len(w) n FROM w) SELECT conv_id, turn, CASE WHEN s>0 THEN round((n*60.0/s)::DOUBLE,6) END wpm, CASE WHEN s>0 THEN round((length(t)/s)::DOUBLE,6) END chars_per_second, round(coalesce(len(regexp_extract_all(t,'[,;:.!?]'))/nullif(n,0),0),6) pause_density, round(coalesce(len(list_filter(w, lambda x: x IN ({', '.join(repr(x) for x in X.FILLERS)})))/nullif(n,0),0),6) filler_ratio, round(coalesce(len(list_filter(w, lambda x: length(x)>9))/nullif(n,0),0),6) rare_ratio FROM n"),
    "f21_metadata": (f21_metadata, "SELECT conv_id, turn, length(coalesce(text,'')) title_len, len(list_filter(string_split_regex(coalesce(text,''),'\\s+'), lambda x: x<>'')) title_words, len(regexp_extract_all(coalesce(text,''),'\\?')) title_questions, round(coalesce(len(regexp_extract_all(coalesce(text,''),'[A-Z]'))/nullif(length(coalesce(text,'')),0),0),7) title_upper FROM conversations"),
    "f22_turns": (f22_turns, f"WITH r AS (SELECT conv_id, role, turn, {_T}[1:60] turn_text FROM conversations), o AS (SELECT * FROM r WHERE length(turn_text)>=20 QUALIFY row_number() OVER (PARTITION BY conv_id, role, lower(turn_text) ORDER BY turn)=1) SELECT conv_id, role, turn, turn_text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn)::INT place FROM o QUALIFY place<=3"),
    "f23_captions": (f23_captions, "SELECT c_custkey, CASE WHEN length(c_name)>=length(c_mktsegment) THEN c_name ELSE c_mktsegment END en, CASE WHEN c_custkey%2=0 THEN 'hallo' END de, CASE WHEN c_custkey%2=0 THEN 2 ELSE 1 END n FROM customer"),
    "f24_channel": (f24_channel, "SELECT c_custkey, CASE c_custkey%3 WHEN 0 THEN c_custkey::VARCHAR WHEN 1 THEN 'ch_'||sha1(c_name)[1:12] ELSE 'vid_'||c_custkey END channel FROM customer"),
    "f25_slots": (f25_slots, "SELECT c_custkey, (concat('0x',sha256(c_name)[1:16])::UBIGINT%7)::BIGINT slot, round(concat('0x',sha256(c_name)[1:16])::UBIGINT::DOUBLE/18446744073709551616.0,9) unit FROM customer"),
    "f28_pad": (f28_pad, "SELECT item_id, array_to_string(list_concat(string_split(text,' '), list_transform(range(20), lambda x: '_'))[1:20],' ') padded, least(len(string_split(text,' ')),20)::INT mask FROM benchmark"),
    "f29_training_json": (f29_training_json, "SELECT o_orderkey, '{\"metadata\":{\"title\":\"'||CASE WHEN o_orderkey%2=0 THEN o_orderstatus ELSE o_orderpriority END||'\",\"o_custkey\":'||o_custkey||'}}' record FROM orders"),
    "f30_first_of": (f30_first_of, "SELECT event_id, coalesce(nullif(event_id%3,0), nullif(event_id%5,0), -1)::BIGINT v FROM events"),
}
