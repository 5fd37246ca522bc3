"""Personal data: patterns, and words that give protected values away, in DataFrame functions.

Values found by patterns (e-mail addresses, IP addresses, card and phone numbers) are the
protected entities. How strongly a word t near an entity c reveals it is estimated from
the corpus: PMI(c, t) = log2(n(c, t) N / (n(c) n(t))), with n(c, t) and n(c) counted over
different surroundings of c (so copies count once), n(t) over all documents and N their
number. The information of an entity is IC(c) = log2(N / n(c)); a word with PMI of at
least REMOVE * IC gives nearly all of it away and is removed from documents that hold c,
one of at least GENERALISE * IC is replaced by its kind. Words seen in fewer than SUPPORT
surroundings of an entity prove nothing.

The patterns say the same as the plain ones they stand for, but hold on to what they have
read and start only where a run starts, so that long texts take linear time.

Null text is empty. Entities and words are joined as narrow rows; texts meet their words only
where there are such words, by id and digest of the text, so that rows that share an id, or
have none, lose only what their own text discloses. Repeated rows each get a row; an empty
table gives none. Other columns come along in one packed column, whatever their names are.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from busgrid.llm.common import packed, table, unpacked, written

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without a match of it has none of the pattern.
HINTS = {"email": "@", "ip": ".", "phone": "+"}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
WORD = r"\p{L}{3,}"
NEAR_WORDS, NEAR_CHARS = 6, 120
SUPPORT, GENERALISE, REMOVE = 3, 0.6, 0.9
CHUNK = 256
SPAN = "struct<kind:string,start:int,end:int,text:string>"


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def _with_spans(rows: DataFrame, patterns: dict[str, Column], text: str = "_t") -> DataFrame:
    """Adds all matches of each pattern with their places in code points, as ``_<kind>``.

    A split gives the text between matches, so places are running sums; sums run inside
    chunks first and then over chunks, so that many matches do not cost their square. Each
    step is a column of its own, as columns are worked out once and expressions in lambda
    functions again and again.
    """

    def found(kind):
        matches = F.regexp_extract_all(text, patterns[kind], F.lit(0))
        hint = F.contains(text, F.lit(HINTS[kind])) if kind in HINTS else F.lit(True)
        some = hint & patterns[kind].isNotNull()
        return F.when(some, matches).otherwise(F.array().cast("array<string>"))

    def pieces(kind):
        between = F.slice(F.split(text, patterns[kind], -1), F.lit(1), F.size(f"_f_{kind}"))
        cut = F.zip_with(
            between,
            f"_f_{kind}",
            lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("match")),
        )
        chunks = F.sequence(F.lit(0), F.floor((F.size(f"_f_{kind}") - 1) / CHUNK).cast("int"))
        chunked = F.transform(chunks, lambda c: F.slice("_cut", c * CHUNK + 1, F.lit(CHUNK)))
        return F.when(F.size(f"_f_{kind}") > 0, cut), chunked

    def starts(kind):
        size = lambda p: p["gap"] + F.length(p["match"])
        sums = F.transform(
            f"_c_{kind}", lambda c: F.aggregate(c, F.lit(0), lambda n, p: n + size(p))
        )
        return F.aggregate(
            sums,
            F.array(F.lit(0)),
            lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)),
        )

    def spans(kind):
        def one(state, p):
            start = state["at"] + p["gap"]
            end = start + F.length(p["match"])
            span = F.struct(
                F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"),
                p["match"].alias("text"),
            )
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

        def of_chunk(chunk, i):
            first = F.struct(F.element_at(f"_s_{kind}", i + 1).alias("at"), _none().alias("out"))
            return F.aggregate(chunk, first, one, lambda state: state["out"])

        return F.coalesce(F.flatten(F.transform(f"_c_{kind}", of_chunk)), _none())

    rows = rows.withColumns({f"_f_{kind}": found(kind) for kind in patterns})
    for kind in patterns:
        cut, chunked = pieces(kind)
        rows = rows.withColumn("_cut", cut).withColumn(
            f"_c_{kind}", F.when(F.col("_cut").isNotNull(), chunked)
        )
    rows = rows.withColumns({f"_s_{kind}": starts(kind) for kind in patterns})
    rows = rows.withColumns({f"_{kind}": spans(kind) for kind in patterns})
    return rows.drop("_cut", *[f"_{part}_{kind}" for kind in patterns for part in "fcs"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(
        each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    )
    return F.aggregate(doubled, F.lit(0), lambda n, d: n + d) % 10 == 0


def _is(kind: str, span: Column) -> Column:
    return span["kind"] == kind


def _sound(kind: str, span: Column) -> Column:
    digits = F.length(_digits(span["text"]))
    if kind == "ip":
        return span["text"].rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.when(digits.between(13, 19), _luhn(_digits(span["text"]))).otherwise(False)
    if kind == "phone":
        return digits.between(9, 15)
    return F.lit(True)


def _with_base(documents: DataFrame) -> DataFrame:
    """Adds ``_t``, the text, and ``_base``, the spans that pass their checks, by kind and place."""
    rows = documents.withColumn("_t", F.coalesce("text", F.lit("")))
    rows = _with_spans(rows, {kind: F.lit(pattern) for kind, pattern in PATTERNS.items()})
    base = F.concat(*[F.filter(f"_{kind}", partial(_sound, kind)) for kind in KINDS])
    return rows.withColumn("_base", base).drop(*[f"_{kind}" for kind in KINDS])


def _value(span: Column) -> Column:
    """What is protected: written in different ways it is the same."""
    value = F.when(span["kind"] == "email", F.lower(span["text"])).when(
        span["kind"] == "ip", span["text"]
    )
    return F.concat(span["kind"], F.lit(":"), F.coalesce(value, _digits(span["text"])))


def _near(text: Column, first: Column, span: Column) -> Column:
    """The words next to a span, lower case; ``text`` is the stretch from place ``first`` on."""
    words = lambda part: F.regexp_extract_all(F.lower(part), F.lit(WORD), F.lit(0))
    from_ = F.greatest(span["start"] - NEAR_CHARS, F.lit(0))
    before = words(F.substring(text, from_ - first + 1, span["start"] - from_))
    after = words(F.substring(text, span["end"] - first + 1, F.lit(NEAR_CHARS)))
    last = F.greatest(F.size(before) - NEAR_WORDS, F.lit(0))
    return F.concat(
        F.slice(before, last + 1, F.lit(NEAR_WORDS)), F.slice(after, F.lit(1), F.lit(NEAR_WORDS))
    )


def _digest(text: str) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def find(documents: DataFrame) -> DataFrame:
    """doc_id, digest of the text, entities and the words around them, written once; no texts."""
    found = _with_base(documents.select("doc_id", "text"))
    # A chunk of spans cuts its stretch of the text once, so that many spans cost no square.
    first = lambda c: F.greatest(
        F.array_min(F.transform(c, lambda s: s["start"])) - NEAR_CHARS, F.lit(0)
    )
    last = lambda c: F.array_max(F.transform(c, lambda s: s["end"])) + NEAR_CHARS
    stretch = lambda c: F.struct(
        c.alias("spans"),
        first(c).alias("first"),
        F.substring("_t", first(c) + 1, last(c) - first(c)).alias("text"),
    )
    found = found.withColumn("_stretches", F.transform(_chunks("_base"), stretch))
    around = lambda c: F.transform(
        c["spans"],
        lambda s: F.struct(
            _value(s).alias("entity"), _near(c["text"], c["first"], s).alias("near")
        ),
    )
    seen = F.flatten(F.transform("_stretches", around))
    digest = F.when(F.size("_base") > 0, _digest("text")).alias("digest")
    return written(found.select("doc_id", digest, seen.alias("seen")), "pii-entities")


def disclosing(found: DataFrame, documents: DataFrame) -> DataFrame:
    """entity, term, removed: the words that give an entity away."""
    seen = found.select(F.explode("seen").alias("s")).select(
        "s.entity", F.xxhash64("s.near").alias("around"), "s.near"
    )
    times = seen.select("entity", "around").distinct().groupBy("entity").count()
    pairs = (
        seen.select("entity", "around", F.explode("near").alias("term"))
        .distinct()
        .groupBy("entity", "term")
        .agg(F.count("*").alias("n_ct"))
        .where(F.col("n_ct") >= SUPPORT)
    )
    pairs = written(pairs.join(times.withColumnRenamed("count", "n_c"), "entity"), "pii-pairs")
    kind = "entity string, term string, removed boolean"
    if pairs.isEmpty():
        return found.sparkSession.createDataFrame([], kind)
    n = float(found.count())
    terms = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))
    # All words are counted first, with partial counts; a row a word then meets the pairs.
    frequent = documents.select(F.explode(terms).alias("term")).groupBy("term").agg(
        F.count("*").alias("n_t")
    )
    pmi = F.log2(F.col("n_ct") * n / (F.col("n_c") * F.col("n_t")))
    information = F.log2(F.lit(n) / F.col("n_c"))
    return written(
        pairs.join(frequent, "term")
        .where((information > 0) & (pmi >= GENERALISE * information))
        .select("entity", "term", (pmi >= REMOVE * information).alias("removed")),
        "pii-terms",
    )


def sanitised_spans(documents: DataFrame) -> DataFrame:
    """doc_id, text, base spans and all spans of each document, and ``_row`` if it is there."""
    found = find(documents)
    words = disclosing(found, documents)
    holds = found.select("doc_id", "digest", F.explode("seen.entity").alias("entity")).distinct()
    # An entity has few words around it that pass, so a document's list is short.
    of_doc = (
        holds.join(words, "entity")
        .groupBy("doc_id", "digest", "term")
        .agg(F.max("removed").alias("removed"))
        .groupBy("doc_id", "digest")
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("removed"), F.col("term")))).alias("_remove_words"),
            F.sort_array(F.collect_list(F.when(~F.col("removed"), F.col("term")))).alias(
                "_general_words"
            ),
        )
        .withColumnRenamed("doc_id", "_of")
    )
    rows = _with_base(documents).withColumn("_own", F.when(F.size("_base") > 0, _digest("text")))
    same = F.col("doc_id").eqNullSafe(F.col("_of")) & (F.col("_own") == F.col("digest"))
    rows = rows.join(of_doc, same, "left")
    pattern = {
        kind: F.when(
            F.size(f"_{kind}_words") > 0,
            F.concat(
                F.lit(r"(?iu)(?<!\p{L})(?:"),
                F.array_join(f"_{kind}_words", "|"),
                F.lit(r")(?!\p{L})"),
            ),
        )
        for kind in ("remove", "general")
    }
    # Base spans in chunks by place: a word looks at the ends of chunks, then into few of them.
    meets = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    ends = F.transform("_base", lambda s: F.struct(s["start"], s["end"]))
    chunk = lambda c: F.struct(
        F.array_min(c)["start"].alias("start"),
        F.array_max(F.transform(c, lambda s: s["end"])).alias("end"),
        c.alias("spans"),
    )
    free = lambda s: ~F.exists(
        "_near", lambda c: meets(c, s) & F.exists(c["spans"], lambda b: meets(b, s))
    )
    rows = (
        _with_spans(rows, pattern)
        .withColumn("_ends", F.sort_array(ends))
        .withColumn("_near", F.transform(_chunks("_ends"), chunk))
    )
    every = F.concat("_base", F.filter("_remove", free), F.filter("_general", free))
    kept = [c for c in ("_row",) if c in documents.columns]
    return rows.select("doc_id", "text", *kept, "_t", "_base", every.alias("_all"))


def _chunks(spans: str) -> Column:
    """A list cut into lists of ``CHUNK``; none for an empty one."""
    starts = F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / CHUNK).cast("int"))
    cut = F.transform(starts, lambda c: F.slice(spans, c * CHUNK + 1, F.lit(CHUNK)))
    return F.when(F.size(spans) > 0, cut).otherwise(F.slice(F.array(F.col(spans)), 1, 0))


def _joined(spans: str) -> Column:
    each = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(each, ",")


def sanitise(documents: DataFrame) -> DataFrame:
    """The documents with spans replaced: values and general words by their kind.

    Spans that overlap become one, with the label of the first. They are taken in chunks:
    each chunk cuts its stretch of the text once, so that many spans cost no square.
    """
    label = lambda kind: F.when(kind == "remove", "").otherwise(
        F.concat(F.lit("["), F.upper(kind), F.lit("]"))
    )
    rows = (
        sanitised_spans(documents.select("doc_id", "text", packed(documents).alias("_row")))
        .withColumn(
            "_spans",
            F.sort_array(F.transform("_all", lambda s: F.struct(s["start"], s["end"], s["kind"]))),
        )
        .withColumn("_chunks", _chunks("_spans"))
        # Up to where the text is covered before each chunk, and after the last one.
        .withColumn(
            "_done",
            F.aggregate(
                F.transform("_chunks", lambda c: F.array_max(F.transform(c, lambda s: s["end"]))),
                F.array(F.lit(0)),
                lambda done, end: F.concat(
                    done, F.array(F.greatest(F.element_at(done, -1), end))
                ),
            ),
        )
        .withColumn(
            "_cut",
            F.transform(
                "_chunks",
                lambda c, i: F.struct(
                    c.alias("spans"),
                    F.element_at("_done", i + 1).alias("from"),
                    F.substring(
                        "_t",
                        F.element_at("_done", i + 1) + 1,
                        F.element_at("_done", i + 2) - F.element_at("_done", i + 1),
                    ).alias("text"),
                ),
            ),
        )
    )

    def piece(state, s, stretch):
        """The text since the spans before, and the label, unless the span goes on from them."""
        at = state["at"]
        gap = F.substring(stretch["text"], at - stretch["from"] + 1, s["start"] - at)
        out = F.concat(state["out"], F.array(F.concat(gap, label(s["kind"]))))
        return F.struct(
            F.greatest(at, s["end"]).alias("at"),
            F.when(s["start"] >= at, out).otherwise(state["out"]).alias("out"),
        )

    def replaced(stretch):
        first = F.struct(
            stretch["from"].alias("at"), F.array().cast("array<string>").alias("out")
        )
        return F.array_join(
            F.aggregate(
                stretch["spans"], first, lambda state, s: piece(state, s, stretch),
                lambda state: state["out"],
            ),
            "",
        )

    tail = F.substring("_t", F.element_at("_done", -1) + 1, F.length("_t"))
    whole = F.concat(F.array_join(F.transform("_cut", replaced), ""), tail)
    text = F.when(F.size("_spans") > 0, whole).otherwise(F.col("text"))
    return rows.select(*unpacked(documents, "_row", text=text))


def op2_pii(spark, sf_dir):
    rows = sanitised_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [
        F.size(F.filter("_base", partial(_is, kind))).cast("long").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(_joined("_base"), 256).alias("base_sha256"),
        _joined("_all").alias("spans"),
    )


OP2_SQL = r"""
with recursive d as (select doc_id, coalesce(text, '') as t from documents),
kinds(pos, kind, pat) as (values
  (1, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'),
  (2, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
  (3, 'card', '[0-9]([\x20-]?[0-9])+'),
  (4, 'phone', '\+[0-9][\x20().0-9-]+[0-9]')),
cut as (
  select doc_id, pos, kind, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') as m,
    string_split_regex(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') as g from d, kinds where pos = 1
  union all
  select doc_id, pos, kind, regexp_extract_all(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
    string_split_regex(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') from d, kinds where pos = 2
  union all
  select doc_id, pos, kind, regexp_extract_all(t, '[0-9]([\x20-]?[0-9])+'),
    string_split_regex(t, '[0-9]([\x20-]?[0-9])+') from d, kinds where pos = 3
  union all
  select doc_id, pos, kind, regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]'),
    string_split_regex(t, '\+[0-9][\x20().0-9-]+[0-9]') from d, kinds where pos = 4),
each as (
  select doc_id, pos, kind, generate_subscripts(m, 1) as i, unnest(m) as m, unnest(g[1:len(m)]) as g
  from cut where len(m) > 0),
placed as (
  select *, sum(length(g) + length(m)) over (partition by doc_id, pos order by i) as stop,
    regexp_replace(m, '[^0-9]', '', 'g') as digits from each),
base as (
  select doc_id, pos, kind, (stop - length(m))::int as start, stop::int as stop, m, digits
  from placed
  where case kind
    when 'email' then true
    when 'ip' then list_max(list_transform(string_split(m, '.'),
                            lambda x: coalesce(try_cast(x as bigint), 999))) <= 255
    when 'phone' then length(digits) between 9 and 15
    else length(digits) between 13 and 19 and list_sum(list_transform(range(length(digits)),
      lambda k: case when k % 2 = 0 then reverse(digits)[k + 1]::int
        else 2 * reverse(digits)[k + 1]::int
          - case when reverse(digits)[k + 1]::int > 4 then 9 else 0 end end)) % 10 = 0
    end),
seen as (
  select b.doc_id, kind || ':' || case kind when 'email' then lower(m) when 'ip' then m else digits end
      as entity,
    regexp_extract_all(lower(substr(t, greatest(start - 120, 0) + 1, start - greatest(start - 120, 0))),
      '\p{L}{3,}')[-6:] ||
    regexp_extract_all(lower(substr(t, stop + 1, 120)), '\p{L}{3,}')[1:6] as near
  from base b join d using (doc_id)),
times as (select entity, count(distinct near) as n_c from seen group by entity),
pairs as (
  select entity, term, count(distinct near) as n_ct
  from (select entity, near, unnest(near) as term from seen) group by entity, term
  having count(distinct near) >= 3),
words as (
  select term, count(*) as n_t
  from (select distinct doc_id, unnest(regexp_extract_all(lower(t), '\p{L}{3,}')) as term from d)
  where term in (select term from pairs) group by term),
terms as (
  select entity, term, log2(n_ct::double * (select count(*) from d) / (n_c * n_t)) as pmi,
    log2((select count(*) from d)::double / n_c) as ic
  from pairs join times using (entity) join words using (term)),
of_doc as (
  select doc_id, term, max(pmi >= 0.9 * ic) as removed
  from (select distinct doc_id, entity from seen) join terms using (entity)
  where ic > 0 and pmi >= 0.6 * ic group by doc_id, term),
letters as (
  select doc_id, generate_subscripts(m, 1) as i, unnest(m) as m, unnest(g[1:len(m)]) as g
  from (select doc_id, regexp_extract_all(t, '\p{L}+') as m, string_split_regex(t, '\p{L}+') as g
        from d where doc_id in (select doc_id from of_doc)) where len(m) > 0),
said as (
  select *, sum(length(g) + length(m)) over (partition by doc_id order by i) as stop from letters),
more as (
  select s.doc_id, case when removed then 5 else 6 end as pos,
    case when removed then 'remove' else 'general' end as kind,
    (stop - length(m))::int as start, stop::int as stop
  from said s join of_doc o on s.doc_id = o.doc_id and lower(s.m) = o.term
  where not exists (select 1 from base b where b.doc_id = s.doc_id
    and b.start < s.stop and s.stop - length(s.m) < b.stop)),
every as (select doc_id, pos, kind, start, stop from base union all select * from more)
select d.doc_id,
  count(*) filter (kind = 'email') as n_email, count(*) filter (kind = 'ip') as n_ip,
  count(*) filter (kind = 'card') as n_card, count(*) filter (kind = 'phone') as n_phone,
  sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by pos, start)
    filter (pos <= 4), '')) as base_sha256,
  coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by pos, start)
    filter (kind is not null), '') as spans
from d left join every using (doc_id) group by d.doc_id
"""
