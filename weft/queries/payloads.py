"""Payload codec queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions import codec, names
from weft import settings
from weft.queries import query
from weft.schemas import EXTERNAL_PREFIX, LIMITS
from weft.sources import adapter as A
from weft.sources import storage
from weft.sources.folders import work_folder

#: Beside the real limit of 32,768 characters, a low one, so that both branches occur.
LOW = 2000


def encode_sql(table, key, field, limit):
    return f"""select {key}, case when length({field}) <= {limit} then {field}
  else '{EXTERNAL_PREFIX}blobs/' || md5({field}) || ' ' || length({field}) end as encoded, length({field}) > {limit} as external from {table}"""


@query(encode_sql("documents", "doc_id", "text", LOW))
def jumbo_encode(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", codec.encode_field(F.col("text"), LOW).alias("encoded"), (F.length("text") > LOW).alias("external"))


@query(encode_sql("documents", "doc_id", "text", LIMITS["result"]))
def jumbo_encode_result(spark, sf):
    n = LIMITS["result"]
    return A.table(spark, sf, "documents").select("doc_id", codec.encode_field(F.col("text"), n).alias("encoded"), (F.length("text") > n).alias("external"))


@query(f"""with k as (select distinct text from documents where doc_id % 5 <> 0), d as (select doc_id, case when length(text) > {LOW} and text not in (select text from k) then
  '{EXTERNAL_PREFIX}blobs/' || md5(text) || ' ' || length(text) else text end as text from documents where text is not null)
select doc_id, md5(text) as digest, length(text) as n from d""")
def jumbo_decode(spark, sf):
    """Fields that are kept outside come back; those whose content is lost stay references."""
    rows, blobs = codec.externalise(A.table(spark, sf, "documents").filter("text is not null").select("doc_id", "text"), "doc_id", "text", LOW)
    there = A.table(spark, sf, "documents").filter(F.col("doc_id") % 5 != 0).filter(F.length("text") > LOW).select(codec.blob_path(F.col("text")).alias("path")).distinct()
    return codec.decode(rows, blobs.join(there, "path", "left_semi"), "text").select("doc_id", F.md5("text").alias("digest"), F.length("text").cast("long").alias("n"))


@query(f"select page_id, length(html) > {LOW} as refused, length(html) > 5000000 as refused_external from pages")
def field_limits(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", codec.too_large(F.col("html"), LOW, False).alias("refused"), codec.too_large(F.col("html"), LOW).alias("refused_external"))


@query("select doc_id, case when length(text) > 256 then substr(text, 1, 252) || ' ...' else text end as identity from documents")
def identity_truncate(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", codec.truncate(F.col("text")).alias("identity"))


@query(f"with {A.EV} select e, props as parsed, props as raw, case when k % 3 = 0 then null when k % 3 = 1 then props end as parsed_cut, nullif(case when k % 3 = 0 then substr(props, 2) when k % 3 = 1 then props else '' end, '') as raw_cut from ev")
def json_or_raw(spark, sf):
    log = A.events(spark, sf)
    cut = F.when(F.col("k") % 3 == 0, F.substr("props", F.lit(2))).when(F.col("k") % 3 == 1, F.col("props")).otherwise("")
    whole, part = codec.json_or_raw(F.col("props")), codec.json_or_raw(cut)
    respaced = lambda c: F.regexp_replace(c, '":', '": ')  # noqa: E731  the log's own spelling
    return log.select("e", respaced(whole["parsed"]).alias("parsed"), whole["raw"].alias("raw"), respaced(part["parsed"]).alias("parsed_cut"), part["raw"].alias("raw_cut"))


@query(f"""with {A.EV} select e, '{{"a":' || k || ',"deep":{{"x":[{{}},{{"y":' || e || '}}]}},"list":[1,' || k || ',[]]}}' as clean, cast(null as varchar) as broken from ev""")
def remove_none(spark, sf):
    """Nulls go at every depth, members and elements, in any order of members; what isn't JSON gives null."""
    text = F.concat(F.lit('{"b": null, "list": [1, null, '), F.col("k"), F.lit(', [null]], "deep": {"z": null, "x": [{"q": null}, null, {"y": '), F.col("e"), F.lit('}]}, "a": '), F.col("k"), F.lit("}"))
    return A.events(spark, sf).select("e", codec.remove_none(text).alias("clean"), codec.remove_none(F.concat(text, F.lit("}"))).alias("broken"))


@query("""with b as (select doc_id, octet_length(encode(text)) as n, list_transform(range(0, octet_length(encode(text))), lambda i: cast('0x' || substr(hex(encode(text)), cast(2 * i + 1 as int), 2) as bigint)) as b from documents where text is not null),
s as (select doc_id, n, (1 + coalesce(list_sum(b), 0)) % 65521 as lo, (n + coalesce(list_sum(list_transform(b, lambda x, i: (n - i + 1) * x)), 0)) % 65521 as hi from b)
select doc_id, case when n = 0 then '0' else lower(ltrim(printf('%08x', cast(hi * 65536 + lo as bigint)), '0')) end as hex_hash from s""")
def hex_hash(spark, sf):
    return A.table(spark, sf, "documents").filter("text is not null").select("doc_id", codec.hex_hash(F.col("text")).alias("hex_hash"))


@query(f"""with {A.EV}, i as (select u, e, et || '-' || md5('{{"args":[' || k || '],"kwargs":{{}}}}') as task_id from ev)
select u, task_id, min(e) as first_event, count(*) as submissions from i group by u, task_id""")
def idempotent_ids(spark, sf):
    log = A.events(spark, sf).select("u", "e", codec.idempotent_id(F.col("et"), F.array("k")).alias("task_id"))
    return log.groupBy("u", "task_id").agg(F.min("e").alias("first_event"), F.count("*").alias("submissions"))


@query("select doc_id, case when length(text) > 256 then substr(text, 1, 223) || '-' || md5(text) else text end as task_id from documents")
def task_id_long(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", codec.short_id(F.col("text")).alias("task_id"))


@query("""select p_partkey, '--brand="' || p_brand || '" -s="' || p_size || '" "' || p_name || '" "' || p_type || '"' as line from part""")
def command_line(spark, sf):
    named = F.create_map(F.lit("brand"), "p_brand", F.lit("s"), F.col("p_size").cast("string"))
    return A.table(spark, sf, "part").select("p_partkey", codec.command_line(F.array("p_name", "p_type"), named).alias("line"))


@query("select p_partkey, replace(url_encode(p_type), '%20', '+') as quoted, case when contains(p_name, ' ') then substr(p_name, 1, length(p_name) - strpos(reverse(p_name), ' ')) else '' end as head, list_last(string_split(p_name, ' ')) as tail from part")
def text_pieces(spark, sf):
    last = names.before_last_dot(F.replace("p_name", F.lit(" "), F.lit(".")))
    return A.table(spark, sf, "part").select("p_partkey", F.url_encode("p_type").alias("quoted"), F.replace(last["head"], F.lit("."), F.lit(" ")).alias("head"), last["tail"].alias("tail"))


@query("""select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || case when epoch_us(ts) % 1000000 = 0 then '' else '.' || lpad(cast((epoch_us(ts) // 1000) % 1000 as varchar), 3, '0') end || 'Z' as iso from events""")
def iso_time(spark, sf):
    return A.table(spark, sf, "events").select("event_id", names.iso_millis(F.col("ts")).alias("iso"))


@query("""select c_custkey, '{"acctbal":' || cast(cast(c_acctbal * 100 as bigint) as varchar) || ',"nation":' || c_nationkey || ',"nothing":null,"segment":"' || c_mktsegment || '"}' as doc from customer""")
def sorted_json(spark, sf):
    c = F.col
    doc = codec.compact_json((c("c_acctbal") * 100).cast("decimal(20,0)").cast("long").alias("acctbal"), c("c_nationkey").alias("nation"), F.lit(None).cast("string").alias("nothing"), c("c_mktsegment").alias("segment"))
    return A.table(spark, sf, "customer").select("c_custkey", doc.alias("doc"))


@query("""select n_nationkey, '[' || string_agg(trim(x), '|') || ']' as tags from (select n_nationkey, unnest(string_split(' a, ' || n_name || ' ,b ', ',')) as x from nation) group by n_nationkey""")
def list_parsing(spark, sf):
    tags = F.transform(F.split(F.concat(F.lit(" a, "), F.col("n_name"), F.lit(" ,b ")), ","), lambda x: F.trim(x))
    return A.table(spark, sf, "nation").select("n_nationkey", F.concat(F.lit("["), F.array_join(tags, "|"), F.lit("]")).alias("tags"))


@query("""select c_custkey, '{"a":[' || c_nationkey || ',null,{"x":"é","y":1}],"b":{"c":"' || c_name || '","z":null}}' as doc,
  '{"a":[' || c_nationkey || ',null,{"x":"\\u00e9","y":1}],"b":{"c":"' || c_name || '","z":null}}' as ascii, cast(null as varchar) as broken from customer""")
def json_dump(spark, sf):
    """Members at every level are put in order; what isn't JSON gives null."""
    text = F.concat(F.lit('{ "b": {"z": null, "c": "'), F.col("c_name"), F.lit('"}, "a": ['), F.col("c_nationkey").cast("string"), F.lit(', null, {"y": 1, "x": "\u00e9"}]}'))
    return A.table(spark, sf, "customer").select("c_custkey", codec.json_dump(text).alias("doc"), codec.json_dump(text, ascii_only=True).alias("ascii"), codec.json_dump(F.concat(text, F.lit("]"))).alias("broken"))


@query(f"with {A.EV} select e, 1.0 + k / 100.0 * pow(2, k % 6) as later, cast(1.5 as double) as always from ev")
def retry_delays(spark, sf):
    return A.events(spark, sf).select("e", names.exponential_delay(F.col("k") % 6, F.col("k") / 100).alias("later"), names.constant_delay(1.5).alias("always"))


@query(f"""with {A.EV} select e, us - (k % 30) * 86400000000 as ago_us, us // 1000000 as seconds, (us // 1000000) * 1000000 as whole_us,
  epoch_us(cast(strftime(make_timestamp(us), '%Y-%m-%d') as timestamp)) as day_us, epoch_us(cast(strftime(make_timestamp(us), '%Y-%m-%d %H:%M') as timestamp)) as minute_us, cast(null as bigint) as bad_us from ev""")
def date_pieces(spark, sf):
    ts = F.timestamp_micros("us")
    at = lambda fmt: names.micros(names.cli_time(F.date_format(ts, fmt)))
    seconds = names.epoch_seconds(ts)
    return A.events(spark, sf).select("e", names.micros(names.days_ago(ts, F.col("k") % 30)).alias("ago_us"), seconds.alias("seconds"), names.micros(names.moment(seconds)).alias("whole_us"), at("yyyy-MM-dd").alias("day_us"), at("yyyy-MM-dd HH:mm").alias("minute_us"), names.micros(names.cli_time(F.date_format(ts, "dd/MM/yyyy"))).alias("bad_us"))


@query(f"with {A.EV} select e, case when k % 10 = 0 then null else 'token-' || e end as task_token, case when k % 10 = 0 then null else u end as workflow_id, case when k % 10 = 0 then null else props end as input from ev")
def fake_poll(spark, sf):
    """Tasks from base64 JSON instead of a poll; every tenth is broken."""
    data = F.to_json(F.struct(F.concat(F.lit("token-"), F.col("e")).alias("task_token"), F.col("u").alias("workflow_id"), F.col("props").alias("input")))
    text = F.when(F.col("k") % 10 == 0, F.lit("!")).otherwise(F.base64(F.encode(data, "UTF-8")))
    return A.events(spark, sf).select("e", codec.poll_data(text, "task_token string, workflow_id long, input string").alias("t")).select("e", "t.*")


@query("select 'nation-' || n_nationkey as object, n_name as content from nation where cast(n_nationkey as varchar) like '1%'")
def object_round_trip(spark, sf):
    """Objects are pushed to a bucket's folder and those of a prefix pulled."""
    folder = work_folder(spark)
    storage.push(A.table(spark, sf, "nation").withColumn("key", F.concat(F.lit("nation-"), "n_nationkey")), folder, "key", "n_name")
    return storage.pull(spark, folder, "nation-1")


@query("select 'nation-' || n_nationkey as object, cast(n_nationkey as varchar) as rest from nation where n_nationkey >= 20 or n_nationkey = 2")
def object_keys(spark, sf):
    folder = work_folder(spark)
    storage.push(A.table(spark, sf, "nation").withColumn("key", F.concat(F.lit("nation-"), "n_nationkey")), folder, "key", "n_name")
    return storage.keys(spark, folder, "nation-2").select("object", names.without_prefix(F.col("object"), F.lit("nation-")).alias("rest"))


BUCKET = "case when s_suppkey % 4 = 0 then 'b-' || s_suppkey when s_suppkey % 4 = 1 then 's3.eu.amazonaws.com/b-' || s_suppkey when s_suppkey % 4 = 2 then 'other.org/b' else 'x.amazonaws.com/a/b' end"


@query(f"select s_suppkey, case when s_suppkey % 4 < 2 then 'b-' || s_suppkey end as bucket, case s_suppkey % 4 when 0 then 's3.amazonaws.com' when 1 then 's3.eu.amazonaws.com' end as host from supplier")
def bucket_hosts(spark, sf):
    return A.table(spark, sf, "supplier").select("s_suppkey", storage.bucket_columns(F.expr(BUCKET)).alias("b")).select("s_suppkey", "b.bucket", "b.host")


@query("select * from (values " + ", ".join(f"('{k}', '{'from-env' if k == 'STEP_BUCKET' else 'from-module' if k == 'METROLOGY_BUCKET' else v}')" for k, (_, v) in settings.DEFAULTS.items()) + ") as t(name, value)")
def settings_resolved(spark, sf):
    got = settings.load({"METROLOGY_BUCKET": "from-module", "STEP_BUCKET": "hidden"}, {"STEP_BUCKET": "from-env"})
    return spark.createDataFrame([(k, str(v)) for k, v in got.items()], "name string, value string")
