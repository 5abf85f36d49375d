"""Queries of the ordered-sequence operators over events: user = video, ts = time, value = curve."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewell.operators import filters as C
from framewell.operators import sequences as S
from framewell.plans.common import table


def _curve(spark, sf):
    e = table(spark, sf, "events").where("ts IS NOT NULL AND user_id IS NOT NULL AND value IS NOT NULL")
    return e.select("user_id", "event_id", "event_type", "value", (F.col("event_id") * 0.5).alias("t"))


_C = "c AS (SELECT user_id, event_id, event_type, value, (event_id*0.5)::DOUBLE t FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL AND value IS NOT NULL)"
_K = ["user_id"]


def _r(df, *cols, digits=5):
    return df.select(*(c for c in df.columns if c not in cols), *(F.round(c, digits).alias(c) for c in cols))


def w03_rate(spark, sf):
    return _r(S.lag_change(_curve(spark, sf), _K, "t", "value").select("event_id", "delta", "rate"), "delta", "rate", digits=9)


def w04_aligned(spark, sf):
    return _r(S.lag_change(_curve(spark, sf), _K, "t", "value", True).select("event_id", "delta"), "delta")


def w05_position(spark, sf):
    return _r(S.position(_curve(spark, sf), _K, "t").select("event_id", "position"), "position", digits=9)


def w06_transitions(spark, sf):
    return S.transitions(_curve(spark, sf), _K, "t", "event_type").select("event_id", "previous", "event_type")


def w07_switches(spark, sf):
    return _r(S.switches(_curve(spark, sf), _K, "t", F.col("value") > 50), "rate", "per_minute", digits=7)


def w08_rolling(spark, sf):
    return S.rolling_anomalies(_curve(spark, sf), _K, "t", "value", 2, 1.6)


def w09_segments(spark, sf):
    return S.label_segments(_curve(spark, sf), _K, "event_id", "event_type")


def w10_uniform_segments(spark, sf):
    return S.uniform_segments(_curve(spark, sf), _K, "t", 5).groupBy("user_id", "segment").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))


def w11_z_score(spark, sf):
    rows = S.z_score(S.z_score(_curve(spark, sf), _K, "value", "a"), _K, "t", "b")
    return rows.select("event_id", F.round(0.5 * F.col("a") + 0.5 * F.col("b"), 5).alias("energy"))


def w11_energy(spark, sf):
    return _r(C.energy(_curve(spark, sf), _K, "t", "value", "t", 1.0, "energy").select("event_id", "energy"), "energy", digits=4)


def w12_energy_peaks(spark, sf):
    """Peaks of the energy at or above its 90th percentile, 20 apart."""
    return _r(C.high_peaks(C.energy(_curve(spark, sf), _K, "t", "value", "t", 1.0, "energy"), _K, "t", "energy", 20.0), "energy", digits=4)


def w12_peaks(spark, sf):
    return S.suppress_by_time(S.local_peaks(_curve(spark, sf), _K, "t", "value"), _K, "t", "value", 400.0)


def w13_hook(spark, sf):
    return _r(S.hook_window(_curve(spark, sf), _K, "t", "value", 300.0), "mean", "max", "std", digits=4)


def w14_climax(spark, sf):
    return _r(S.climax(_curve(spark, sf), _K, "t", "value"), "position", digits=9)


def w15_density(spark, sf):
    return _r(S.density_bins(_curve(spark, sf), _K, "t", 5000.0, 500.0), "density_var", digits=9)


def w16_bins(spark, sf):
    return _r(S.uniform_bins(_curve(spark, sf), _K, "t", "value", 5000.0, 8), "mean", "max", "p50", "p90", digits=9)


def w17_windows(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    return S.plan_windows(d, "n_chars", 200, 150, 12).select("doc_id", "start")


def w18_union_windows(spark, sf):
    return w18_union_windows_all(spark, sf)


def w18_union_windows_all(spark, sf):
    """Documents of any length. Of the sampled frames (each fourth up to the length) only those in a window are made."""
    d = table(spark, sf, "documents").select("doc_id", F.coalesce("n_chars", F.length("text").cast("bigint")).alias("n_chars"))
    w = S.plan_windows(d, "n_chars", 32, 64, 8)
    inside = w.select("doc_id", "n_chars", F.explode(F.sequence("start", F.col("start") + 15)).alias("frame"))
    frames = inside.where("frame % 4 = 0 AND frame <= n_chars").distinct().withColumn("place", F.expr("frame div 4"))
    return S.union_windows(w, frames, ["doc_id"], "start", 16, "frame", "place").select("doc_id", "lo", "hi", "n")


def w19_blocks(spark, sf):
    return _r(S.block_means(_curve(spark, sf), _K, "t", "value"), "least_mean")


def w20_budget(spark, sf):
    c = table(spark, sf, "conversations").withColumn("len", F.length(F.coalesce("text", F.lit(""))))
    return S.prefix_budget(c, ["conv_id"], "turn", F.col("len"), 400).select("conv_id", "turn")


def w21_chunks(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.size(F.split(F.coalesce("text", F.lit("")), " ")).cast("bigint").alias("tokens"))
    return S.chunk_by_budget(c, ["conv_id"], "turn", "tokens", 64, 1)


def w22_decreasing(spark, sf):
    return S.decreasing(_curve(spark, sf), _K, "event_id", F.when(F.col("event_id") % 3 != 0, F.floor("value") + F.col("event_id") / 10))


def w23_balance(spark, sf):
    c = _curve(spark, sf).withColumn("amount", (F.floor("value") * F.when(F.col("event_type") == "purchase", -1).otherwise(1)).cast("bigint"))
    return S.running_balance(c, _K, ["event_id"], "amount").select("event_id", "balance")


def w25_smoothness(spark, sf):
    return _r(S.smoothness(_curve(spark, sf), _K, "t", "value", 40.0), "smoothness")


def w26_trend(spark, sf):
    return _r(S.trend(_curve(spark, sf), _K, "t", "value"), "slope", "intercept", digits=6)


def w26_savgol(spark, sf):
    return _r(C.savgol(_curve(spark, sf), _K, "t", "value", 5, 2, "trend").select("event_id", "trend"), "trend", digits=6)


def w26_periodicity(spark, sf):
    return S.periodicity(_curve(spark, sf), _K, "event_id", "value")


def w27_peaks(spark, sf):
    return S.local_peaks(_curve(spark, sf), _K, "t", "value").where("value > 60").select("event_id", "value")


def w27_top_jumps(spark, sf):
    return C.top_jumps(_curve(spark, sf), _K, "t", "value", 20.0, 5, 3).select("user_id", "event_id", "place", "rank")


def a39_dominant(spark, sf):
    return _r(S.dominant(_curve(spark, sf), _K, "event_id", "event_type", "value"), "stability", digits=7)


def a40_intervals(spark, sf):
    return _r(S.intervals(_curve(spark, sf), _K, "t"), "mean", "std", "min", "max", "median", "regularity", "tempo", digits=5)


def a41_speech(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "role", F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z0-9]+"), 0)).alias("tokens"))
    per = c.groupBy("conv_id", "role").agg(F.sum("tokens").alias("s"))
    share = per.groupBy("conv_id").agg(F.try_divide(F.max("s").cast("double"), F.sum("s")).alias("dominant_share"))
    return _r(c.groupBy("conv_id").agg(F.sum("tokens").alias("total"), F.avg("tokens").alias("mean"), F.stddev_pop("tokens").alias("std")).join(share, "conv_id"), "mean", "std", "dominant_share", digits=6)


def a42_shape(spark, sf):
    return _r(S.shape(_curve(spark, sf), ["event_type"], "value"), "skew", "kurtosis", "entropy", "high_share", digits=6)


def a42_circular(spark, sf):
    return _r(S.circular(_curve(spark, sf), ["event_type"], F.col("value") / 20.0), "mean", "std", digits=6)


def a43_otsu(spark, sf):
    return S.otsu(_curve(spark, sf).withColumn("v", F.col("value") / 100.0), ["event_type"], "v")


def a47_line(spark, sf):
    c = _curve(spark, sf).withColumn("x", F.least(F.greatest("t", F.lit(100.0)), F.lit(4000.0)))
    return _r(S.trend(c, ["event_type"], "x", "value"), "slope", "intercept", digits=7)


_WS = _C + ", w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t) i, count(*) OVER (PARTITION BY user_id) n, lag(value) OVER (PARTITION BY user_id ORDER BY t) pv, lag(t) OVER (PARTITION BY user_id ORDER BY t) pt, lag(event_type) OVER (PARTITION BY user_id ORDER BY t) pe, lead(value) OVER (PARTITION BY user_id ORDER BY t) nv FROM c)"
_L = _C + ", l AS (SELECT user_id, list(event_id ORDER BY t) e, list(value ORDER BY t) a, list(t ORDER BY t) b, count(*) n FROM c GROUP BY 1)"
_G = "list_transform(range(n), lambda i: list_sum(list_transform(range(9), lambda j: " + str([round(float(x), 17) for x in C.gaussian_weights(1.0)]) + "[j+1]*{v}[CASE WHEN (i+j-4+2*n*9)%(2*n)<n THEN (i+j-4+2*n*9)%(2*n)+1 ELSE 2*n-(i+j-4+2*n*9)%(2*n) END])))"
_Z = "list_transform({v}, lambda x: (x-list_avg({v}))/(list_stddev_pop({v})+1e-6))"

QUERIES = {
    "w03_rate": (w03_rate, f"WITH {_WS} SELECT event_id, round(value-pv,9) delta, round((value-pv)/greatest(t-pt,0.001),9) rate FROM w"),
    "w04_aligned": (w04_aligned, f"WITH {_WS} SELECT event_id, round(coalesce(value-pv,0),5) delta FROM w"),
    "w05_position": (w05_position, f"WITH {_WS} SELECT event_id, round(CASE WHEN n>1 THEN (i-1)/(n-1) ELSE 0 END,9) AS position FROM w"),
    "w06_transitions": (w06_transitions, f"WITH {_WS} SELECT event_id, pe previous, event_type FROM w WHERE pe<>event_type"),
    "w07_switches": (w07_switches, f"WITH {_WS} SELECT user_id, coalesce(sum(((value>50)<>(pv>50))::INT),0)::BIGINT switches, round(CASE WHEN count(*)>1 THEN sum(((value>50)<>(pv>50))::INT)/(count(*)-1) ELSE 0 END,7) rate, CASE WHEN max(t)>min(t) THEN round(sum(((value>50)<>(pv>50))::INT)*60/(max(t)-min(t)),7) END per_minute FROM w GROUP BY 1"),
    "w08_rolling": (w08_rolling, f"WITH {_WS}, z AS (SELECT user_id, i, abs(value-avg(value) OVER f)/nullif(stddev_samp(value) OVER f,0) z FROM w WINDOW f AS (PARTITION BY user_id ORDER BY t ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)), h AS (SELECT *, CASE WHEN i-lag(i) OVER (PARTITION BY user_id ORDER BY i)<=5 THEN 0 ELSE 1 END s FROM z WHERE z>1.6), g AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY i) island FROM h) SELECT user_id, island::BIGINT island, min(i)::INT AS first, max(i)::INT AS last, count(*) n FROM g GROUP BY ALL"),
    "w09_segments": (w09_segments, f"WITH {_WS}, g AS (SELECT *, sum(CASE WHEN pe=event_type THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY t) island FROM w) SELECT user_id, island::BIGINT island, any_value(event_type) event_type, min(event_id) AS first, max(event_id) AS last, count(*) n FROM g GROUP BY user_id, island"),
    "w10_uniform_segments": (w10_uniform_segments, f"WITH {_WS} SELECT user_id, least((i-1)//greatest(n//5,1),4)::INT segment, count(*) n, min(event_id) AS first FROM w GROUP BY user_id, 2"),
    "w11_z_score": (w11_z_score, f"WITH {_C} SELECT event_id, round(0.5*(value-avg(value) OVER u)/(stddev_pop(value) OVER u+1e-6)+0.5*(t-avg(t) OVER u)/(stddev_pop(t) OVER u+1e-6),5) energy FROM c WINDOW u AS (PARTITION BY user_id)"),
    "w11_energy": (w11_energy, f"WITH {_L}, s AS (SELECT e, n, {_G.format(v='a')} a, {_G.format(v='b')} b FROM l), z AS (SELECT e, n, {_Z.format(v='a')} a, {_Z.format(v='b')} b FROM s), m AS (SELECT e, n, list_transform(range(n), lambda i: 0.5*a[i+1]+0.5*b[i+1]) m FROM z), g AS (SELECT e, {_G.format(v='m')} g FROM m), o AS (SELECT unnest(e) event_id, unnest({_Z.format(v='g')}) energy FROM g) SELECT event_id, round(energy,4) energy FROM o"),
    "w12_energy_peaks": (w12_energy_peaks, None),
    "w12_peaks": (w12_peaks, None),
    "w13_hook": (w13_hook, f"WITH {_WS}, e AS (SELECT *, min(t) OVER u + least(300.0, 0.15*(max(t) OVER u - min(t) OVER u)) e FROM w WINDOW u AS (PARTITION BY user_id)), k AS (SELECT *, sum((t<=e)::INT) OVER (PARTITION BY user_id) k FROM e) SELECT user_id, count(*) n, round(avg(value),4) mean, round(max(value),4) max, round(stddev_pop(value),4) std FROM k WHERE t<=e OR (k<3 AND i<=3) GROUP BY 1"),
    "w14_climax": (w14_climax, f"WITH {_WS} SELECT user_id, value peak, round(CASE WHEN n>1 THEN (i-1)/(n-1) ELSE 0 END,9) AS position FROM w QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, t)=1"),
    "w15_density": (w15_density, f"WITH {_C}, b AS (SELECT user_id, least(floor(t/500),9) b, count(*) c FROM c GROUP BY ALL), f AS (SELECT user_id, unnest(range(10)) b FROM (SELECT DISTINCT user_id FROM c)) SELECT user_id, round(var_pop(coalesce(c,0)/500.0),9) density_var, sum(c)::BIGINT events FROM f LEFT JOIN b USING (user_id,b) GROUP BY 1"),
    "w16_bins": (w16_bins, f"WITH {_C}, b AS (SELECT user_id, greatest(0,least(ceil(t/625)-1,7))::BIGINT bin, avg(value) a, max(value) x, quantile_cont(value,0.5) p, quantile_cont(value,0.9) q FROM c GROUP BY ALL), f AS (SELECT user_id, unnest(range(8)) bin FROM (SELECT DISTINCT user_id FROM c)) SELECT user_id, bin, round(a,9) mean, round(x,9) max, round(p,9) p50, round(q,9) p90, (a IS NOT NULL)::INT mask FROM f LEFT JOIN b USING (user_id,bin)"),
    "w17_windows": (w17_windows, "WITH d AS (SELECT doc_id, greatest(n_chars-200,0) l FROM documents), s AS (SELECT doc_id, list_sort(list_distinct(list_append(range(0,l+1,150),l))) s FROM d), x AS (SELECT doc_id, CASE WHEN len(s)>12 THEN list_distinct(list_transform(range(12), lambda i: s[1+round_even(i*(len(s)-1)/11.0,0)::INT])) ELSE s END s FROM s) SELECT doc_id, unnest(s) AS start FROM x"),
    "w18_union_windows": (w18_union_windows, "WITH d AS (SELECT doc_id, coalesce(n_chars,length(text)) n, greatest(coalesce(n_chars,length(text))-32,0) l FROM documents), s AS (SELECT doc_id, n, list_sort(list_distinct(list_append(range(0,l+1,64),l))) s FROM d), x AS (SELECT doc_id, n, CASE WHEN len(s)>8 THEN list_distinct(list_transform(range(8), lambda i: s[1+round_even(i*(len(s)-1)/7.0,0)::INT])) ELSE s END s FROM s), w AS (SELECT doc_id, n, unnest(s) a FROM x), f AS (SELECT doc_id, a, unnest(range(a,a+16)) f, n FROM w), h AS (SELECT doc_id, a, min(f//4) lo, max(f//4) hi, count(*) n FROM f WHERE f%4=0 AND f<=n GROUP BY ALL) SELECT doc_id, lo, hi, max(n) n FROM h GROUP BY ALL"),
    "w18_union_windows_all": (w18_union_windows_all, None),
    "w19_blocks": (w19_blocks, f"WITH {_WS}, b AS (SELECT user_id, (i-1)//greatest(1,round_even(n/10.0,0)::BIGINT) b, avg(value) m FROM w GROUP BY ALL) SELECT user_id, round(min(m),5) least_mean, count(*) blocks FROM b GROUP BY 1"),
    "w20_budget": (w20_budget, "SELECT conv_id, turn FROM conversations QUALIFY sum(length(coalesce(text,''))) OVER (PARTITION BY conv_id ORDER BY turn)<=400"),
    "w21_chunks": (w21_chunks, None),
    "w22_decreasing": (w22_decreasing, f"WITH {_C}, v AS (SELECT user_id, event_id, floor(value)+event_id/10 v FROM c WHERE event_id%3<>0), d AS (SELECT user_id, v<lag(v) OVER (PARTITION BY user_id ORDER BY event_id) d FROM v), g AS (SELECT user_id, bool_or(d) d FROM d GROUP BY 1) SELECT user_id, coalesce(d,false) decreasing FROM (SELECT DISTINCT user_id FROM c) LEFT JOIN g USING (user_id)"),
    "w23_balance": (w23_balance, f"WITH {_C} SELECT event_id, sum(floor(value)*CASE WHEN event_type='purchase' THEN -1 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT balance FROM c"),
    "w25_smoothness": (w25_smoothness, f"WITH {_WS}, d AS (SELECT user_id, t, value-pv d FROM w), e AS (SELECT user_id, d, d-lag(d) OVER (PARTITION BY user_id ORDER BY t) dd FROM d) SELECT user_id, round(avg(abs(dd)),5) smoothness, count(*) FILTER (abs(d)>40) jumps FROM e GROUP BY 1"),
    "w26_trend": (w26_trend, f"WITH {_C} SELECT user_id, round(regr_slope(value,t),6) slope, round(regr_intercept(value,t),6) intercept FROM c GROUP BY 1"),
    "w26_savgol": (w26_savgol, f"WITH {_C}, w AS (SELECT event_id, value, row_number() OVER v i, count(*) OVER (PARTITION BY user_id) n, list(value) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) x FROM c WINDOW v AS (PARTITION BY user_id ORDER BY t)), f AS (SELECT *, greatest(0, least(i-3, n-5)) s FROM w) SELECT event_id, round(CASE WHEN n<=5 THEN value ELSE (CASE i-s WHEN 1 THEN 31*x[s+1]+9*x[s+2]-3*x[s+3]-5*x[s+4]+3*x[s+5] WHEN 2 THEN 9*x[s+1]+13*x[s+2]+12*x[s+3]+6*x[s+4]-5*x[s+5] WHEN 3 THEN -3*x[s+1]+12*x[s+2]+17*x[s+3]+12*x[s+4]-3*x[s+5] WHEN 4 THEN -5*x[s+1]+6*x[s+2]+12*x[s+3]+13*x[s+4]+9*x[s+5] ELSE 3*x[s+1]-5*x[s+2]-3*x[s+3]+9*x[s+4]+31*x[s+5] END)/35 END,6) trend FROM f"),
    "w26_periodicity": (w26_periodicity, None),
    "w27_top_jumps": (w27_top_jumps, f"WITH RECURSIVE {_WS}, p AS (SELECT user_id, event_id, i-1 AS p, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, i DESC) AS o FROM w WHERE i>2 AND i<n-1 AND value>=20 AND value>=pv AND value>nv), r AS (SELECT DISTINCT user_id, 0::BIGINT AS o, []::BIGINT[] AS k, NULL::BIGINT AS event_id, NULL::BIGINT AS p, false AS got FROM p UNION ALL SELECT p.user_id, p.o, CASE WHEN len(k)<3 AND len(list_filter(k, lambda x: abs(x-p.p)<5))=0 THEN list_append(k, p.p) ELSE k END, p.event_id, p.p, len(k)<3 AND len(list_filter(k, lambda x: abs(x-p.p)<5))=0 FROM r JOIN p ON p.user_id=r.user_id AND p.o=r.o+1) SELECT user_id, event_id, p::INT AS place, len(k)::INT AS rank FROM r WHERE got"),
    "w27_peaks": (w27_peaks, f"WITH {_WS} SELECT event_id, value FROM w WHERE value>=pv AND value>nv AND value>60"),
    "a39_dominant": (a39_dominant, f"WITH {_C}, p AS (SELECT user_id, event_type, count(*) c, min(event_id) f, sum(value) s FROM c GROUP BY ALL), q AS (SELECT *, sum(s) OVER (PARTITION BY user_id) a FROM p) SELECT user_id, event_type dominant, round(s/nullif(a,0),7) stability FROM q QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY c DESC, f)=1"),
    "a40_intervals": (a40_intervals, f"WITH {_WS}, d AS (SELECT user_id, t-pt d FROM w WHERE t>pt) SELECT user_id, count(*) n, round(avg(d),5) mean, round(stddev_pop(d),5) std, min(d) min, max(d) max, round(median(d),5) median, round(1/(1+stddev_pop(d)/avg(d)),5) regularity, round(60/median(d),5) tempo FROM d GROUP BY 1"),
    "a41_speech": (a41_speech, "WITH c AS (SELECT conv_id, role, len(regexp_extract_all(coalesce(text,''),'[A-Za-z0-9]+')) k FROM conversations), p AS (SELECT conv_id, role, sum(k) s FROM c GROUP BY ALL), q AS (SELECT conv_id, max(s)/nullif(sum(s),0) d FROM p GROUP BY 1) SELECT conv_id, sum(k)::BIGINT total, round(avg(k),6) mean, round(stddev_pop(k),6) std, round(any_value(d),6) dominant_share FROM c JOIN q USING (conv_id) GROUP BY 1"),
    "a42_shape": (a42_shape, f"WITH {_C}, m AS (SELECT event_type e, median(value) m, avg(value) a, count(*) n FROM c GROUP BY 1), s AS (SELECT event_type e, (sum((value-a)**3)/count(*))/(stddev_pop(value)**3) skew, (sum((value-a)**4)/count(*))/(stddev_pop(value)**4)-3 kurtosis FROM c JOIN m ON e=event_type GROUP BY 1), h AS (SELECT event_type e, CASE WHEN value<0 THEN 0 WHEN value>=100 THEN 17 ELSE floor(value/6.25)+1 END b, count(*) c FROM c GROUP BY ALL), t AS (SELECT e, -sum(c/n*ln(c/n)) entropy FROM h JOIN m USING (e) GROUP BY 1), d AS (SELECT event_type e, median(abs(value-m)) mad FROM c JOIN m ON e=event_type GROUP BY 1), x AS (SELECT event_type e, avg((value>m+3*mad)::INT) hs FROM c JOIN m ON m.e=event_type JOIN d ON d.e=event_type GROUP BY 1) SELECT e event_type, round(skew,6) skew, round(kurtosis,6) kurtosis, round(entropy,6) entropy, round(hs,6) high_share FROM s JOIN t USING (e) JOIN x USING (e)"),
    "a42_circular": (a42_circular, f"WITH {_C}, a AS (SELECT event_type, avg(sin(value/20)) s, avg(cos(value/20)) k FROM c GROUP BY 1) SELECT event_type, round(atan2(s,k),6) mean, round(sqrt(-2*ln(least(sqrt(s*s+k*k),1))),6) std FROM a"),
    "a43_otsu": (a43_otsu, f"WITH {_C}, h AS (SELECT event_type e, least(floor(value/100.0*128),127) b, count(*) c FROM c WHERE value>=0 AND value<=100 GROUP BY ALL), x AS (SELECT *, (b+0.5)/128 x FROM h), w AS (SELECT e, b, x, sum(c) OVER u w0, sum(c*x) OVER u m0, sum(c) OVER (PARTITION BY e) n, sum(c*x) OVER (PARTITION BY e) m FROM x WINDOW u AS (PARTITION BY e ORDER BY b)), v AS (SELECT e, b, x, round(w0*(n-w0)*((m0/w0)-(m-m0)/nullif(n-w0,0))**2,9) v FROM w WHERE n>w0), t AS (SELECT e, x FROM v QUALIFY row_number() OVER (PARTITION BY e ORDER BY v DESC, b)=1) SELECT event_type, coalesce(x,0.97)::DOUBLE threshold FROM (SELECT DISTINCT event_type FROM c WHERE value>=0 AND value<=100) LEFT JOIN t ON e=event_type"),
    "a47_line": (a47_line, f"WITH {_C} SELECT event_type, round(regr_slope(value,least(greatest(t,100),4000)),7) slope, round(regr_intercept(value,least(greatest(t,100),4000)),7) intercept FROM c GROUP BY 1"),
}
