"""Requests, keys, answers, reuse, and generated request tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonetally import schemas
from zonetally.functions import columns as C
from zonetally.functions import domains as D
from zonetally.operators import generate as G
from zonetally.operators import requests as R
from zonetally.operators import sketches as SK
from zonetally.operators import ttl
from zonetally.operators import zones as Z
from zonetally.plans.fixtures import buildings, requests, table
from zonetally.plans.kpi_queries import payloads
from zonetally.plans.registry import query, rounded
from zonetally.plans.zone_queries import _index_sql
from zonetally.session import store
from zonetally.sources.readers import split_json
from zonetally.sources.writers import topic_records

RQ, ALL = ("requests",), ("zones", "buildings", "requests")

KEY = """case query_type when 'Q1' then 'count:' || zone_a || ':conf=' || printf('%.2f', confidence_min)
  when 'Q2' then 'area:' || zone_a || ':conf=' || printf('%.2f', confidence_min)
  when 'Q3' then 'density:' || zone_a || ':conf=' || printf('%.2f', confidence_min)
  when 'Q4' then 'compare:density:' || zone_a || ':' || zone_b || ':conf=' || printf('%.2f', confidence_min)
  when 'Q5' then 'confidence_dist:' || zone_a || ':bins=' || bins end"""


def keyed(spark, d):
    return R.with_key(requests(spark, d))


@query("prj05_enriched_requests", """
select request_id, 36 as uuid_length, 0 as retry_count, true as has_time from requests""", RQ)
def _(spark, d):
    messages = R.enrich(requests(spark, d).select("request_id", "query_type"))
    return messages.select("request_id", F.length("uuid").alias("uuid_length"), "retry_count",
                           (F.col("created_at") > 0).alias("has_time"))


def _messages(spark, d):
    """Requests as they come in: parameters as JSON, some left out."""
    r, pair = requests(spark, d), F.col("query_type") == "Q4"
    params = F.struct(
        F.when(~pair, F.col("zone_a")).alias("zone_id"), F.when(pair, F.col("zone_a")).alias("zone_a"),
        F.when(pair, F.col("zone_b")).alias("zone_b"),
        F.when(F.col("request_id") % 7 != 0, F.col("confidence_min")).alias("confidence_min"),
        F.when(F.col("request_id") % 5 != 0, F.col("bins")).alias("bins"))
    return r.select("request_id", "query_type", F.to_json(params).alias("params"),
                    F.when(F.col("request_id") % 3 != 0, F.col("retry_count")).alias("retry_count"))


@query("prj07_typed_params", """
select request_id, query_type, case when query_type <> 'Q4' then zone_a end as zone_id, case when query_type = 'Q4' then zone_a end as zone_a,
  case when query_type = 'Q4' then zone_b end as zone_b, case when request_id % 7 <> 0 then confidence_min else 0 end as confidence_min,
  case when request_id % 5 <> 0 then bins else 5 end as bins, case when request_id % 3 <> 0 then retry_count else 0 end as retry_count
from requests""", RQ)
def _(spark, d):
    return R.typed_params(_messages(spark, d), schemas.REQUEST_PARAMS)


@query("prj08_request_key", f"select request_id, {KEY} as cache_key from requests", RQ)
def _(spark, d):
    return keyed(spark, d).select("request_id", "cache_key")


@query("prj09_partition_key", """
select request_id, case when query_type <> 'Q4' then case when request_id % 4 = 0 then 'Z0' else zone_a end else zone_a end as key from requests""", RQ)
def _(spark, d):
    zone_id = F.when(F.col("query_type") != "Q4", F.when(F.col("request_id") % 4 == 0, "").otherwise(F.col("zone_a")))
    zone_a = F.when(F.col("query_type") == "Q4", F.col("zone_a"))
    return requests(spark, d).select("request_id", C.partition_key(zone_id, zone_a).alias("key"))


@query("prj11_time_to_live", """
select request_id, case query_type when 'Q1' then 300 when 'Q2' then 300 when 'Q3' then 180 when 'Q4' then 120 when 'Q5' then 600 else 300 end as ttl
from requests""", RQ)
def _(spark, d):
    return requests(spark, d).select("request_id", C.time_to_live(F.col("query_type")).alias("ttl"))


@query("flt03_malformed_json", """
select case when event_id % 97 = 0 then 'rejected' else 'readable' end as side, count(*) as n
from query_events where event = 'processed' group by 1""", ("query_events",))
def _(spark, d):
    good, bad = split_json(payloads(spark, d))

    def count(df, side):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(side).alias("side"), "n")

    return count(good, "readable").unionByName(count(bad, "rejected"))


@query("flt04_rejected_requests", """
select request_id, case when query_type = 'Q6' then 'unknown query type' when request_id % 11 = 0 then 'zone missing'
  when query_type = 'Q4' and request_id % 13 = 0 then 'second zone missing' end as reject_reason from requests""", RQ)
def _(spark, d):
    r = requests(spark, d).withColumns({
        "zone_a": F.when(F.col("request_id") % 11 != 0, F.col("zone_a")),
        "zone_b": F.when(F.col("request_id") % 13 != 0, F.col("zone_b"))})
    return R.with_reject_reason(r, Z.zone_dimension(spark)).select("request_id", "reject_reason")


@query("flt04_rejected_runs", """
select request_id, case when request_id % 5 = 0 then 'mode' when request_id % 7 = 0 then 'distribution' when confidence_min = 0 then 'rate'
  when bins = 3 and retry_count = 0 then 'duration or count' when retry_count = 3 then 'probability' end as reject_reason from requests""", RQ)
def _(spark, d):
    i = F.col("request_id")
    reason = C.run_reject_reason(
        F.when(i % 5 == 0, "batch").when(i % 2 == 0, "kafka").otherwise("sync"),
        F.when(i % 7 == 0, "pareto").when(i % 2 == 0, "zipf").otherwise("uniform"),
        F.col("confidence_min") * 50, F.when(F.col("bins") != 3, F.lit(25.0)),
        F.when(F.col("retry_count") != 0, F.lit(100)), F.col("retry_count") / F.lit(2.0))
    return requests(spark, d).select("request_id", reason.alias("reject_reason"))


# ---- answers -----------------------------------------------------------------

def _answers_sql(source: str) -> str:
    return f"""
with rq as ({source}),
ask as (select distinct z as zone_id, confidence_min from (
  select zone_a as z, confidence_min from rq where query_type in ('Q1', 'Q2', 'Q3', 'Q4')
  union all select zone_b, confidence_min from rq where query_type = 'Q4')),
tot as (select a.zone_id, a.confidence_min, count(b.zone_id) as n, coalesce(sum(area_in_meters), 0) as area,
  count(b.zone_id) / any_value(area_km2) as density
  from ask a join zones z on z.zone_id = a.zone_id
  left join buildings b on b.zone_id = a.zone_id and (a.confidence_min <= 0 or b.confidence >= a.confidence_min) group by 1, 2),
hask as (select distinct zone_a as zone_id, bins from rq where query_type = 'Q5'),
prof as (select zone_id, confidence, count(*) as n from buildings where confidence between 0 and 1 group by 1, 2),
hidx as (select h.zone_id, h.bins, {_index_sql('confidence', 'h.bins')} as bucket, sum(n) as n
  from hask h join prof p on p.zone_id = h.zone_id group by 1, 2, 3),
hist as (select g.zone_id, g.bins, string_agg(cast(coalesce(i.n, 0) as bigint)::varchar, ',' order by g.bucket) as bucket_counts
  from (select zone_id, bins, unnest(range(0, bins)) as bucket from hask) g
  left join hidx i on i.zone_id = g.zone_id and i.bins = g.bins and i.bucket = g.bucket group by 1, 2)
select r.request_id, r.query_type, {KEY.replace('confidence_min', 'r.confidence_min').replace('bins end', 'r.bins end')} as cache_key,
  case when query_type in ('Q1', 'Q2', 'Q3') then a.n end as n,
  case when query_type = 'Q2' then round(case when a.n > 0 then a.area / a.n else 0 end, 4) end as avg_area,
  case when query_type = 'Q2' then round(a.area, 4) end as total_area,
  case when query_type in ('Q3', 'Q4') then round(a.density, 6) end as density_a,
  case when query_type = 'Q4' then round(b.density, 6) end as density_b,
  case when query_type = 'Q4' then case when a.density > b.density then zone_a else zone_b end end as winner, bucket_counts
from rq r left join tot a on a.zone_id = zone_a and a.confidence_min = r.confidence_min and query_type <> 'Q5'
left join tot b on b.zone_id = zone_b and b.confidence_min = r.confidence_min and query_type = 'Q4'
left join hist h on h.zone_id = zone_a and h.bins = r.bins and query_type = 'Q5'
where query_type <> 'Q6'"""


def _flat(answers):
    out = answers.withColumn("bucket_counts", F.array_join(F.col("buckets.count").cast("array<string>"), ",")).drop("buckets")
    return rounded(rounded(out, 4, "avg_area", "total_area"), 6, "density_a", "density_b")


@query("jn04_answered_requests", _answers_sql("select * from requests"), ALL)
def _(spark, d):
    return _flat(R.answer_requests(requests(spark, d), buildings(spark, d), Z.zone_dimension(spark)))


@query("jn04_answers_at_any_floor", _answers_sql("""select request_id, query_type, zone_a, zone_b,
  (request_id % 37) / 37::double as confidence_min, case when request_id % 9 = 0 then 65 + retry_count else bins end as bins from requests"""), ALL)
def _(spark, d):
    asked = requests(spark, d).withColumns({
        "confidence_min": (F.col("request_id") % 37) / F.lit(37.0),
        "bins": F.when(F.col("request_id") % 9 == 0, F.col("retry_count") + 65).otherwise(F.col("bins"))})
    return _flat(R.answer_requests(asked, buildings(spark, d), Z.zone_dimension(spark)))


def _broken(spark, d):
    """Requests with missing, unusable and very large parameters."""
    i = F.col("request_id")
    return requests(spark, d).withColumns({
        "confidence_min": F.when(i % 5 == 0, None).when(i % 7 == 0, F.lit(float("nan"))).otherwise(F.col("confidence_min")),
        "bins": F.when(i % 11 == 0, 0).when(i % 13 == 0, None).when(i % 17 == 0, -3).when(i % 997 == 0, 100_000).otherwise(F.col("bins"))})


BROKEN = """select * replace (case when request_id % 5 = 0 then null when request_id % 7 = 0 then 'nan'::double else confidence_min end as confidence_min,
  case when request_id % 11 = 0 then 0 when request_id % 13 = 0 then null when request_id % 17 = 0 then -3 when request_id % 997 = 0 then 100000 else bins end as bins) from requests"""
WHY = """case when query_type = 'Q6' then 'unknown query type' when query_type <> 'Q5' and isnan(confidence_min) then 'floor is not a number'
  when query_type = 'Q5' and bins < 1 then 'bins must be positive' end"""


@query("jn04_answers_and_rejects", f"""
with broken as ({BROKEN}) select case when {WHY} is null then 'answer' else {WHY} end as side, count(*) as n from broken group by 1""", RQ)
def _(spark, d):
    """Every request has an answer or a reason why not."""
    asked, zones = _broken(spark, d), Z.zone_dimension(spark)
    answers = R.answer_requests(asked, buildings(spark, d), zones).agg(F.count(F.lit(1)).alias("n")).select(F.lit("answer").alias("side"), "n")
    rejects = R.with_reject_reason(asked, zones).where("reject_reason is not null")
    return answers.unionByName(rejects.groupBy(F.col("reject_reason").alias("side")).agg(F.count(F.lit(1)).alias("n")))


@query("jn04_answers_with_defaults", _answers_sql(f"""
select * replace (coalesce(confidence_min, 0) as confidence_min, coalesce(bins, 5) as bins) from ({BROKEN}) where {WHY} is null"""), ALL)
def _(spark, d):
    return _flat(R.answer_requests(_broken(spark, d), buildings(spark, d), Z.zone_dimension(spark)))


CUT = 1704153600.0  # 2024-01-02
STORED = f"""
with k as (select *, {KEY} as cache_key from requests where query_type <> 'Q6'),
stored as (select cache_key, max(created_at) as stored_at from k where created_at < {CUT} group by 1)
"""


def _stored(spark, d):
    k = keyed(spark, d).where(F.col("query_type") != "Q6")
    stored = k.where(F.col("created_at") < CUT).groupBy("cache_key").agg(F.max("created_at").alias("stored_at"))
    return k.where(F.col("created_at") >= CUT), stored


@query("jn05_result_lookup", STORED + f"""
select request_id, cache_key, stored_at, case when stored_at is null then 'MISS' else 'HIT' end as cache
from k left join stored using (cache_key) where created_at >= {CUT}""", RQ)
def _(spark, d):
    return R.look_up(*_stored(spark, d)).select("request_id", "cache_key", "stored_at", "cache")


@query("jn05_keys_to_compute", STORED + f"""
select distinct cache_key from k where created_at >= {CUT} and cache_key not in (select cache_key from stored)""", RQ)
def _(spark, d):
    return R.to_compute(*_stored(spark, d))


@query("jn05_already_stored", STORED + f"""
select request_id from k where created_at >= {CUT} and cache_key in (select cache_key from stored)""", RQ)
def _(spark, d):
    return R.already_stored(*_stored(spark, d)).select("request_id")


@query("agg23_distinct_keys", f"select count(distinct cache_key) as n_keys from (select {KEY} as cache_key from requests)", RQ)
def _(spark, d):
    return R.distinct_keys(keyed(spark, d))


@query("agg23_distinct_keys_approximate", "select true as within_3_percent", RQ)
def _(spark, d):
    """Whether the sketch lies within 3 % of the exact count (3 keys at least)."""
    about, exact = (R.distinct_keys(keyed(spark, d), approximate=a).scalar() for a in (True, False))
    return spark.range(1).select((F.abs(about - exact) <= F.greatest(F.lit(3), exact * 0.03)).alias("within_3_percent"))


@query("agg23_distinct_keys_of_periods", f"""
select weekofyear(t) as week, query_type in ('Q1', 'Q2', 'Q3') as one_zone, count(*) as n, count(distinct cache_key) as exact_keys, true as within_3_percent
from (select {KEY} as cache_key, query_type, make_timestamp(cast(round(created_at * 1e6) as bigint)) as t from requests) group by 1, 2""", RQ)
def _(spark, d):
    """Distinct keys per week and group of types out of stored sketches per day and type, next to the exact counts."""
    asked = [F.weekofyear("day").alias("week"), F.col("query_type").isin("Q1", "Q2", "Q3").alias("one_zone")]
    daily = keyed(spark, d).withColumn("day", F.to_date(F.timestamp_seconds("created_at")))
    sketches = store(spark, SK.distinct_sketches(daily, ["query_type", "day"]), "sketches")
    about = SK.distinct_of(sketches, asked)
    exact = daily.groupBy(*asked).agg(F.count_distinct("cache_key").alias("exact_keys"))
    near = F.abs(F.col("n_keys") - F.col("exact_keys")) <= F.col("exact_keys") * 0.03
    return about.join(exact, ["week", "one_zone"]).select("week", "one_zone", "n", "exact_keys", near.alias("within_3_percent"))


TTL = f"""
with k as (select request_id, {KEY} as cache_key, cast(round(created_at * 1e6) as bigint) as us,
  720000000::bigint * case query_type when 'Q1' then 300 when 'Q2' then 300 when 'Q3' then 180 when 'Q4' then 120 else 600 end as ttl
  from requests where query_type <> 'Q6'),
f as (select cache_key, min(us) as us, any_value(ttl) as ttl from k group by 1
  union all select f.cache_key, min(k.us), any_value(f.ttl) from f join k on k.cache_key = f.cache_key and k.us >= f.us + f.ttl group by f.cache_key, f.us),
flag as (select request_id, k.cache_key, case when f.us is not null and row_number() over (partition by k.cache_key, k.us order by request_id) = 1
  then 'MISS' else 'HIT' end as cache from k left join f on f.cache_key = k.cache_key and f.us = k.us)
"""


def timed(spark, d):
    return keyed(spark, d).where(F.col("query_type") != "Q6")


def _long_ttl():
    """Seconds by type; the test requests are sparse, so answers stay valid 720 times as long."""
    return C.time_to_live(F.col("query_type")) * 720


@query("win09_hit_or_miss", TTL + "select request_id, cache_key, cache from flag", RQ)
def _(spark, d):
    out = ttl.hit_or_miss(timed(spark, d), "created_at", _long_ttl(), "request_id")
    return out.select("request_id", "cache_key", "cache")


@query("win09_hits_per_key", TTL + """
select cache_key, count(*) filter (where cache = 'HIT') as hits, count(*) filter (where cache = 'MISS') as misses from flag group by 1""", RQ)
def _(spark, d):
    out = ttl.hit_or_miss(timed(spark, d), "created_at", _long_ttl(), "request_id")
    return out.groupBy("cache_key").agg(
        F.count_if(F.col("cache") == "HIT").alias("hits"), F.count_if(F.col("cache") == "MISS").alias("misses"))


@query("snk01_topic_records", """
select zone_a as key, 'main' as topic, request_id, query_type from requests where query_type <> 'Q6'""", RQ)
def _(spark, d):
    r = requests(spark, d).where(F.col("query_type") != "Q6")
    key = C.partition_key(F.when(F.col("query_type") != "Q4", F.col("zone_a")), F.col("zone_a"))
    records = topic_records(r, "main", key, ["request_id", "query_type"])
    return records.select("key", "topic", F.get_json_object("value", "$.request_id").cast("bigint").alias("request_id"),
                          F.get_json_object("value", "$.query_type").alias("query_type"))


# ---- generated tables --------------------------------------------------------

def _u_sql(*parts: str) -> str:
    text = " || '/' || ".join(f"cast({p} as varchar)" for p in parts)
    return f"(('0x' || substr(md5({text}), 1, 13))::bigint / 4503599627370496::double)"


def _bounds(weights):
    total, cum, out = sum(weights), 0.0, []
    for w in weights:
        cum += w
        out.append(cum / total)
    return out


def _pick_sql(u: str, items: list, weights: list[float]) -> str:
    def text(i):
        return f"'{i}'" if isinstance(i, str) else (f"{i!r}::double" if isinstance(i, float) else str(i))

    whens = " ".join(f"when {u} < {b!r}::double then {text(i)}" for i, b in list(zip(items, _bounds(weights)))[:-1])
    return f"case {whens} else {text(items[-1])} end"


USERS = """
with ranked as (select user_id, row_number() over (order by user_id) as rank from (select distinct user_id from events)),
probs as (select *, pow(rank, -1.2::double) / sum(pow(rank, -1.2::double)) over () as probability from ranked),
bounds as (select *, sum(probability) over (order by rank) as hi, sum(probability) over (order by rank) - probability as lo from probs)
"""


def _users(spark, d):
    """Users in the order of their ids, with the probability of their rank."""
    users = table(spark, d, "events").select("user_id").distinct()
    ranked = G.rank_by(users, "user_id")
    return G.zipf_probabilities(ranked, "rank")


@query("win06_zipf_weights", USERS + "select user_id, rank, round(probability, 10) as probability from probs")
def _(spark, d):
    return rounded(_users(spark, d), 10, "probability")


@query("gen01_weighted_sample", USERS + f"""
select event_id, b.user_id, b.rank from (select event_id, {_u_sql("'draw'", "event_id")} as u from events) e
join bounds b on u >= lo and u < hi""")
def _(spark, d):
    intervals = G.cumulative_intervals(_users(spark, d), "rank")
    draws = table(spark, d, "events").select("event_id", C.uniform01("draw", F.col("event_id")).alias("u"))
    return G.sample_items(draws, "u", intervals).select("event_id", "user_id", "rank")


GAPS = f"with g as (select event_id, -ln(1 - {_u_sql(chr(39) + 'gap' + chr(39), 'event_id')}) as gap from events)"


def _arrivals(spark, d, **spike):
    rows = table(spark, d, "events").select("event_id")
    gap = G.unit_gap(C.uniform01("gap", F.col("event_id")))
    out = G.arrival_times(rows, "event_id", gap, F.floor(F.col("event_id") / 4096), 50.0, **spike)
    return rounded(out, 4, "arrival_sec")


@query("win08_poisson_arrivals", GAPS + """
select event_id, round((sum(gap) over (order by event_id) - gap) / 50, 4) as arrival_sec from g""")
def _(spark, d):
    return _arrivals(spark, d)


@query("gen02_arrivals_with_spike", GAPS + """,
s as (select event_id, sum(gap) over (order by event_id) - gap as unit_at from g),
turn as (select min(unit_at) as t from s where unit_at >= 20 * 50)
select event_id, round(case when unit_at > t then t / 50 + (unit_at - t) / 250 else unit_at / 50 end, 4) as arrival_sec from s, turn""")
def _(spark, d):
    return _arrivals(spark, d, spike_at=20.0, spike_rate=250.0)


def _requests_sql() -> str:
    def draw(items, salt):
        return _pick_sql(_u_sql("42", f"'{salt}'", "event_id"), items, C.zipf_weights(len(items), 1.2))

    pair = _u_sql("42", "'pair'", "event_id")
    other = " ".join(f"when '{z}' then {_pick_sql(pair, *others)}" for z, others in G.other_zone_choices(1.2).items())
    return f"""
with q as (select event_id, {draw(D.QUERY_POPULARITY, 'type')} as query_type, {draw(D.ZONE_POPULARITY, 'zone')} as zone_a from events)
select event_id, query_type, zone_a, case when query_type = 'Q4' then case zone_a {other} end end as zone_b,
  case when query_type <> 'Q5' then {draw(D.CONFIDENCE_LEVELS, 'floor')} end as confidence_min,
  case when query_type = 'Q5' then {draw(D.BIN_LEVELS, 'bins')} end as bins from q"""


@query("gen03_request_table", _requests_sql())
def _(spark, d):
    return G.build_requests(table(spark, d, "events").select("event_id"), "event_id")
