"""Quotation linking for conversations, in DataFrame functions only.

Quoted lines (``> ``, nested ``> > ``) are parsed to levels; runs of lines of one level are passages,
whose normalised text is hashed and joined to the unquoted text (whole messages, paragraphs, lines,
and consecutive lines or sentences, as many as a passage of the conversation has) of earlier messages
of the conversation. What remains is each message without its quotes, with the message that it
replies to and its place in the conversation, where a message is followed by all replies to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import text_or_empty, written

#: A quoted line's mark.
MARK = r"^[ \t]{0,3}(>[ \t]?)+"
#: Turns in one part of a conversation; windows over messages never span more of one than this.
PART = 64


def lines_of(text: Column) -> Column:
    return F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n")


def unquoted(text: Column) -> Column:
    """The text without quoted lines; blank lines around them are closed up."""
    own = F.array_join(F.filter(lines_of(text), lambda x: ~x.rlike(MARK)), "\n")
    return F.regexp_replace(F.regexp_replace(own, r"\n[ \t]*\n(?:[ \t]*\n)+", "\n\n"), r"^\s+|\s+$", "")


def normal(text: Column) -> Column:
    """Lower case, white space to single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def full_lines(text: Column) -> Column:
    """The normalised lines that aren't blank."""
    return F.filter(F.transform(F.split(text, "\n"), normal), lambda x: x != "")


def sentences(text: Column) -> Column:
    """The normalised sentences, wherever lines break."""
    return F.filter(F.split(normal(text), r"(?<=[.!?\u2026]) "), lambda x: x != "")


def spans(pieces: Column, lengths: Column) -> Column:
    """All runs of consecutive pieces, of each of the lengths."""
    return F.flatten(F.transform(lengths, lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.size(pieces) - k + 1, F.lit(1))), lambda i: F.array_join(F.slice(pieces, i, k), " "))))


def unit_key(conv: Column, text: Column) -> Column:
    """One hash of the conversation and a normalised passage."""
    return F.md5(F.concat(F.coalesce(conv.cast("string"), F.lit("null")), F.lit("|"), text))


def quotes(messages: DataFrame) -> DataFrame:
    """(conv, turn, own, level, passage, key): the quoted passages of each distinct quoting message."""
    quoting = messages.filter(F.exists(lines_of(F.col("text")), lambda x: x.rlike(MARK))).select("conv", "turn", "own", "text").distinct()
    lines = quoting.select("conv", "turn", "own", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    lines = lines.withColumn("level", F.length(F.regexp_replace(F.regexp_extract("line", f"({MARK})", 1), "[^>]", ""))).withColumn("line", F.regexp_replace("line", MARK, ""))
    message = Window.partitionBy("conv", "turn", "own").orderBy("pos")
    change = F.when(F.lag("level").over(message) == F.col("level"), 0).otherwise(1)
    runs = lines.withColumn("change", change).withColumn("run", F.sum("change").over(message)).filter("level > 0")
    passages = runs.groupBy("conv", "turn", "own", "run", "level").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("lines"))
    passages = passages.withColumn("raw", F.array_join(F.transform("lines", lambda x: x["line"]), "\n")).withColumn("passage", normal(F.col("raw"))).filter("passage <> ''")
    sizes = [F.size(full_lines(F.col("raw"))).alias("n_lines"), F.size(sentences(F.col("raw"))).alias("n_sentences")]
    return passages.select("conv", "turn", "own", "run", "level", "passage", unit_key(F.col("conv"), F.col("passage")).alias("key"), *sizes)


def lengths(messages: DataFrame, quoted: DataFrame) -> DataFrame:
    """(conv, part, by_line, by_sentence): the lengths of a conversation's passages, for each of its parts."""
    found = quoted.groupBy("conv").agg(F.collect_set("n_lines").alias("by_line"), F.collect_set("n_sentences").alias("by_sentence"))
    p, f = messages.select("conv", "part").distinct().alias("p"), found.alias("f")
    return p.join(f, F.expr("p.conv <=> f.conv")).select("p.conv", "p.part", "f.by_line", "f.by_sentence")


def originals(messages: DataFrame, quoted: DataFrame) -> DataFrame:
    """(key, first): each normalised unit of a message that a passage may be, and the first turn that has it.

    Units are the whole message, paragraphs, lines, and runs of consecutive lines (blank ones aside) or
    sentences, of the lengths that the conversation's passages have.
    """
    cut = messages.withColumn("part", F.floor(F.col("turn") / PART))
    m, n = cut.alias("m"), lengths(cut, quoted).alias("n")
    cut = m.join(n, F.expr("m.conv <=> n.conv and m.part <=> n.part")).select("m.conv", "m.turn", unquoted(F.col("m.text")).alias("body"), "n.by_line", "n.by_sentence")
    body = F.col("body")
    units = F.transform(F.concat(F.array(body), F.split(body, r"\n[ \t]*\n"), F.split(body, "\n")), normal)
    units = F.array_distinct(F.concat(units, spans(full_lines(body), F.col("by_line")), spans(sentences(body), F.col("by_sentence"))))
    exploded = cut.select("conv", "turn", F.explode(units).alias("unit")).filter("unit <> ''")
    return exploded.select(unit_key(F.col("conv"), F.col("unit")).alias("key"), "turn").groupBy("key").agg(F.min("turn").alias("first"))


def conv_key(conv: Column) -> Column:
    """A text that is never null, other than that of any conversation for a null one."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def turns(messages: DataFrame, links: DataFrame) -> DataFrame:
    """(c, turn, seq, previous, link, run): each turn of a conversation, numbered from 1.

    ``run`` is the number of the last turn so far that doesn't answer the turn before it. Windows span
    parts of a conversation, and what comes before a part is found in one row a part.
    """
    rows = messages.select(conv_key(F.col("conv")).alias("c"), "turn").filter("turn is not null").distinct().join(links, ["c", "turn"], "left").withColumn("part", F.floor(F.col("turn") / PART))
    inside = Window.partitionBy("c", "part").orderBy("turn")
    parts = rows.groupBy("c", "part").agg(F.count("*").alias("n"), F.max("turn").alias("last"))
    earlier = Window.partitionBy("c").orderBy("part")
    parts = parts.select("c", "part", F.coalesce(F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"), F.lag("last").over(earlier).alias("earlier"))
    rows = rows.withColumn("at", F.row_number().over(inside)).withColumn("inside", F.lag("turn").over(inside)).join(parts, ["c", "part"])
    rows = rows.withColumn("seq", F.col("offset") + F.col("at")).withColumn("previous", F.coalesce("inside", "earlier"))
    rows = rows.withColumn("head", F.when(F.col("previous").isNull() | (F.col("link") != F.col("previous")), F.col("seq")))
    heads = rows.groupBy("c", "part").agg(F.max("head").alias("own")).select("c", "part", F.max("own").over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias("held"))
    run = F.coalesce(F.max("head").over(inside.rowsBetween(Window.unboundedPreceding, 0)), "held")
    return rows.join(heads, ["c", "part"]).select("c", "turn", "seq", "previous", "link", run.alias("run"))


def positions(numbered: DataFrame) -> DataFrame:
    """(c, turn, previous, position) of :func:`turns`, in reply order: each message, then all replies to it, the earliest first.

    A run of turns that each answer the one before stays together, and the runs that branch off follow
    it, those from its last turns first. Where no run branches off that is the order of turns. Sizes
    of branches and their places are summed by doubling, in rounds that grow with the logarithm of
    the depth of branches; each round's table is written.
    """
    at = numbered.select("c", F.col("turn").alias("link"), F.col("run").alias("parent"), F.col("seq").alias("branch"))
    heads = numbered.filter("seq = run").join(at, ["c", "link"], "left").select("c", "run", "parent", "branch")
    runs = numbered.groupBy("c", "run").agg(F.count("*").alias("own")).join(heads, ["c", "run"])
    if numbered.filter("link is not null and link <> previous").isEmpty():
        return numbered.select("c", "turn", "previous", F.col("seq").alias("position"))
    runs = written(runs, "runs")

    def doubled(rows: DataFrame, up_sum: bool) -> DataFrame:
        """``value`` summed over all runs below (and the run itself), or over all above."""
        while not rows.filter("up is not null").isEmpty():
            above = rows.select("c", F.col("run").alias("up"), F.col("up").alias("farther"), F.col("value").alias("held"))
            nxt = rows.join(above, ["c", "up"], "left")
            if up_sum:
                below = rows.filter("up is not null").groupBy("c", F.col("up").alias("run")).agg(F.sum("value").alias("more"))
                nxt = nxt.join(below, ["c", "run"], "left").select("c", "run", F.col("farther").alias("up"), (F.col("value") + F.coalesce("more", F.lit(0))).alias("value"))
            else:
                nxt = nxt.select("c", "run", F.col("farther").alias("up"), (F.col("value") + F.coalesce("held", F.lit(0))).alias("value"))
            rows = written(nxt, "doubled")
        return rows.select("c", "run", "value")

    sizes = doubled(runs.select("c", "run", F.col("parent").alias("up"), F.col("own").alias("value")), True).withColumnRenamed("value", "size")
    siblings = Window.partitionBy("c", "parent").orderBy(F.desc("branch"), "run").rowsBetween(Window.unboundedPreceding, -1)
    parents = runs.select("c", F.col("run").alias("parent"), F.col("own").alias("length"))
    steps = runs.join(sizes, ["c", "run"]).join(parents, ["c", "parent"], "left").withColumn("before", F.coalesce(F.sum("size").over(siblings), F.lit(0)))
    steps = steps.select("c", "run", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(F.col("length") + F.col("before")).cast("long").alias("value"))
    starts = doubled(written(steps, "steps"), False)
    return numbered.join(starts, ["c", "run"]).select("c", "turn", "previous", (F.col("value") + F.col("seq") - F.col("run") + 1).alias("position"))


def link_quotes(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, text (without quotes), n_quotes, n_linked, reply_to, position, line.

    A passage links to the first turn of its conversation whose unquoted whole text, a paragraph, or a
    run of consecutive lines or sentences of it is the same after normalisation, if that turn is
    earlier. ``reply_to`` is the linked turn of the lowest quote level, of equal ones the latest;
    without linked quotes, the turn before (null for the first). ``position`` is the turn's place in
    its conversation from 1, in reply order (see :func:`positions`); of several messages with one turn
    the lowest level and latest link counts. ``line`` is the message as a chat line. Null texts are
    empty; null turns quote nothing, reply to nothing and have no position; null conversation ids are
    one conversation; a null role is an empty one in ``line``. Repeated rows give repeated rows. An
    empty table gives an empty result. Other columns aren't read.
    """
    src = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), text_or_empty(text_col).alias("text"))
    messages = src.withColumn("own", F.md5("text"))
    quoted = quotes(messages)
    hits = quoted.join(originals(messages, quoted), "key", "left").withColumn("hit", F.when(F.col("first") < F.col("turn"), F.col("first")))
    best = F.min(F.when(F.col("hit").isNotNull(), F.struct("level", (-F.col("hit")).alias("back"))))
    found = hits.groupBy("conv", "turn", "own").agg(F.count("*").alias("n_quotes"), F.count("hit").alias("n_linked"), best.alias("best"))
    links = found.filter("best is not null").groupBy(conv_key(F.col("conv")).alias("c"), "turn").agg((-F.min("best")["back"]).alias("link"))
    order = positions(turns(messages, links))
    m, q, b = messages.withColumn("c", conv_key(F.col("conv"))).alias("m"), found.alias("q"), order.alias("b")
    out = m.join(q, F.expr("m.conv <=> q.conv and m.turn <=> q.turn and m.own = q.own"), "left").join(b, F.expr("m.c = b.c and m.turn = b.turn"), "left")
    out = out.select(F.col("m.conv").alias("conv_id"), "m.turn", "m.role", unquoted(F.col("m.text")).alias("text"), F.coalesce("q.n_quotes", F.lit(0)).cast("long").alias("n_quotes"), F.coalesce("q.n_linked", F.lit(0)).cast("long").alias("n_linked"), F.coalesce(-F.col("q.best.back"), F.col("b.previous")).alias("reply_to"), F.col("b.position").cast("long").alias("position"))
    return out.withColumn("line", F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>"), "text"))


def conversations(linked: DataFrame) -> DataFrame:
    """(conv_id, position, line) of linked messages, each conversation's lines in reply order, in sorted partitions.

    A conversation of any length is a run of rows, and a long one is dealt to several partitions, in
    order. Messages of one turn are put in order of their lines; those without a turn come first.
    """
    return linked.select("conv_id", "position", "line").repartitionByRange("conv_id", "position", "line").sortWithinPartitions("conv_id", "position", "line")


#: link_quotes over ``conversations``, in DuckDB SQL.
SQL = r"""
with recursive m as (
  select conv_id as conv, cast(turn as bigint) as turn, role, coalesce(text, '') as text, md5(coalesce(text, '')) as own,
         string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)) as lines
  from conversations),
c as (
  select conv, turn, role, own, lines,
         regexp_replace(regexp_replace(array_to_string(list_filter(lines, lambda x: not regexp_matches(x, '^[ \t]{0,3}(>[ \t]?)+')), chr(10)),
           '\n[ \t]*\n(?:[ \t]*\n)+', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') as body
  from m),
l as (
  select conv, turn, own, pos, lines[pos] as raw,
         length(regexp_replace(regexp_extract(lines[pos], '(^[ \t]{0,3}(>[ \t]?)+)', 1), '[^>]', '', 'g')) as level
  from (select conv, turn, own, lines, unnest(range(1, len(lines) + 1)) as pos from (select distinct conv, turn, own, lines from c))),
r as (
  select *, sum(change) over (partition by conv, turn, own order by pos) as run
  from (select *, case when lag(level) over (partition by conv, turn, own order by pos) = level then 0 else 1 end as change from l)),
p0 as (
  select conv, turn, own, run, level, string_agg(regexp_replace(raw, '^[ \t]{0,3}(>[ \t]?)+', ''), chr(10) order by pos) as quoted
  from r where level > 0 group by conv, turn, own, run, level),
p as (
  select *, len(list_filter(string_split(quoted, chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g')) <> '')) as n_lines,
         len(string_split(regexp_replace(passage, '([.!?\x{2026}]) ', '\1' || chr(10), 'g'), chr(10))) as n_sentences
  from (select *, trim(regexp_replace(lower(quoted), '\s+', ' ', 'g')) as passage from p0) where passage <> ''),
k as (select conv, list(distinct n_lines) as by_line, list(distinct n_sentences) as by_sentence from p group by conv),
o0 as (
  select c.conv, c.turn, body, by_line, by_sentence,
         list_filter(list_transform(string_split(body, chr(10)), lambda x: trim(regexp_replace(lower(x), '\s+', ' ', 'g'))), lambda x: x <> '') as full_lines,
         string_split(regexp_replace(trim(regexp_replace(lower(body), '\s+', ' ', 'g')), '([.!?\x{2026}]) ', '\1' || chr(10), 'g'), chr(10)) as sentences
  from c join k on c.conv is not distinct from k.conv),
u as (
  select conv, turn, trim(regexp_replace(lower(unit), '\s+', ' ', 'g')) as unit
  from (select conv, turn, unnest(list_concat([body], list_concat(string_split_regex(body, '\n[ \t]*\n'), string_split(body, chr(10))))) as unit from o0)
  union all
  select conv, turn, array_to_string(full_lines[i : i + n - 1], ' ') from (select *, unnest(range(1, len(full_lines) - n + 2)) as i from (select *, unnest(by_line) as n from o0))
  union all
  select conv, turn, array_to_string(sentences[i : i + n - 1], ' ') from (select *, unnest(range(1, len(sentences) - n + 2)) as i from (select *, unnest(by_sentence) as n from o0))),
o as (select conv, unit, min(turn) as first from u where unit <> '' group by conv, unit),
h as (
  select p.conv, p.turn, p.own, p.level, case when o.first < p.turn then o.first end as hit
  from p left join o on p.conv is not distinct from o.conv and p.passage = o.unit),
f as (
  select conv, turn, own, count(*) as n_quotes, count(hit) as n_linked, min(struct_pack(level := level, back := -hit)) filter (where hit is not null) as best
  from h group by conv, turn, own),
g as (select conv, turn, -min(best).back as link from f where best is not null group by conv, turn),
b as (
  select t.*, g.link from (select conv, turn, row_number() over (partition by conv order by turn) as seq, lag(turn) over (partition by conv order by turn) as previous
    from (select distinct conv, turn from m where turn is not null)) t left join g on t.conv is not distinct from g.conv and t.turn = g.turn),
e as (select *, max(case when previous is null or link <> previous then seq end) over (partition by conv order by seq) as run from b),
w as (select x.conv, x.run, y.run as parent, y.seq as branch from e x left join e y on x.conv is not distinct from y.conv and x.link = y.turn where x.seq = x.run),
z(conv, run, path) as (
  select conv, run, cast([] as bigint[]) from w where parent is null
  union all select w.conv, w.run, list_concat(z.path, [-w.branch, w.run]) from w join z on w.conv is not distinct from z.conv and w.parent = z.run),
n as (select e.conv, e.turn, e.previous, row_number() over (partition by e.conv order by z.path, e.seq) as position from e join z on e.conv is not distinct from z.conv and e.run = z.run)
select c.conv as conv_id, c.turn, c.role, c.body as text, cast(coalesce(f.n_quotes, 0) as bigint) as n_quotes,
       cast(coalesce(f.n_linked, 0) as bigint) as n_linked, coalesce(-f.best.back, n.previous) as reply_to, n.position,
       '<|' || coalesce(c.role, '') || '|>' || c.body as line
from c left join f on c.conv is not distinct from f.conv and c.turn is not distinct from f.turn and c.own = f.own
       left join n on c.conv is not distinct from n.conv and c.turn = n.turn
"""
