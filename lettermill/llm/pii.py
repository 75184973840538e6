"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Base patterns (e-mail, IP address, card and telephone number) and long hexadecimal secrets find the seed entities. Tokens
that hold a digit or an at sign are candidates; candidates that follow one another on a line are a run. Each whole seed of a
run is an instance, and so is each stretch of other candidates between them. An instance stands in lexical patterns: the two
words before its run, the one word before it (alone, and with the word after it), and its shape (which kinds of characters
follow one another, and how many in all). The graph of patterns and instances is scored in rounds: a pattern by the share of
its distinct instances that are trusted, an instance by the patterns it stands in. Patterns of high confidence then mark
unseen identifiers (kind id) wherever they occur. Texts are read once; only spans, digests of instances and their patterns
are moved.

What it can find: identifiers of another form where seeds stand in the same words, and values shaped like seeds that fail
their checks. What it can't: identifiers without a digit or an at sign, and those that share neither words nor shape with
any seed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.regexlib import let
from .common import table, written

_LOCAL, _OCTET = r"A-Za-z0-9._%+-", r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
#: Possessive, and begun only where a run begins or the last match ended: the same matches as the plain greedy patterns,
#: in linear time and constant stack whatever the text.
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A token with a digit or an at sign in it.
CANDIDATE = r"[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: Candidates that follow one another on a line, however many, with at most the punctuation of telephone numbers between: a
#: base span is never in two runs, as it has 19 digits at most.
RUN = rf"(?<![^\x20\x09-\x0D]){CANDIDATE}(?:[\x20\x09]++(?:[().-]++[\x20\x09]++)*+{CANDIDATE})*+"
#: Long runs of hexadecimal digits, in lower or upper case, with figures and letters among them.
SECRET = r"(?<![0-9A-Za-z])(?:(?=[0-9]*+[a-f])(?=[a-f]*+[0-9])[0-9a-f]{32,}+|(?=[0-9]*+[A-F])(?=[A-F]*+[0-9])[0-9A-F]{32,}+)(?![0-9A-Za-z])"
KINDS = ("email", "ip", "card", "phone")
SEEDS = (*KINDS, "secret")

ROUNDS = 3
#: A pattern needs so many distinct trusted instances, and such a score, to mark others.
MIN_SUPPORT, MIN_SCORE = 3, 0.8
#: Parts that the scores of patterns are copied to, so that a pattern's edges meet them in so many tasks.
SALTS = 8
_SPAN, _MATCH = "array<struct<start:long,end:long>>", "array<struct<start:long,end:long,value:string,before:string,after:string>>"


def _blocks(items: Column) -> Column:
    """An array cut into slices of about the square root of its size: what is built within a slice, and then over slices,
    costs the power 1.5 of the size at most."""
    def cut(z):
        width = F.greatest(F.lit(64), F.ceil(F.sqrt(F.size(z))).cast("int"))
        return let(width, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(z), F.lit(1)), w), lambda i: F.slice(z, i, w)))

    return let(items, cut)


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value, before, after) for all leftmost, non-overlapping matches; code points, end exclusive;
    before and after are the texts between this match and its neighbours."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    zipped = let(F.split(text, pattern, -1), lambda gaps: F.transform(found, lambda m, i: F.struct(m.alias("value"), F.get(gaps, i).alias("before"), F.get(gaps, i + 1).alias("after"))))
    size = lambda x: F.length(x["before"]) + F.length(x["value"])
    zero, none = F.lit(0).cast("long"), F.expr(f"cast(array() as {_MATCH})")
    at = lambda acc, x: F.struct((acc["at"] + F.length(x["before"])).alias("start"), (acc["at"] + size(x)).alias("end"), x["value"].alias("value"), x["before"].alias("before"), x["after"].alias("after"))
    step = lambda acc, x: F.struct((acc["at"] + size(x)).alias("at"), F.concat(acc["out"], F.array(at(acc, x))).alias("out"))

    def placed(blocks):
        return let(F.transform(blocks, lambda own: F.aggregate(own, zero, lambda n, x: n + size(x))), lambda sizes: F.flatten(F.transform(blocks, lambda own, i: F.aggregate(
            own, F.struct(F.aggregate(F.slice(sizes, F.lit(1), i), zero, lambda n, x: n + x).alias("at"), none.alias("out")), step, lambda acc: acc["out"]
        ))))

    return let(_blocks(zipped), placed)


def _if(gate: Column, spans: Column) -> Column:
    return F.when(gate, spans).otherwise(F.expr(f"cast(array() as {_MATCH})"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    figures = F.reverse(_digits(value))
    places = F.transform(F.split(figures, ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(places, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """kind -> array of (start, end, value, before) of valid base matches. Failing matches are dropped, not retried."""
    size = lambda m: F.length(_digits(m["value"]))
    return {
        "email": _if(F.contains(text, F.lit("@")), _matches(text, EMAIL)),
        "ip": F.filter(_if(text.rlike(r"[0-9]\.[0-9]"), _matches(text, IP)), lambda m: m["value"].rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")),
        "card": F.filter(_if(text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), _matches(text, CARD)), lambda m: size(m).between(16, 19) & _luhn(m["value"])),
        "phone": F.filter(_if(F.contains(text, F.lit("+")), _matches(text, PHONE)), lambda m: size(m).between(8, 15)),
    }


def _merged(spans: Column) -> Column:
    """Spans (start, end) by start, overlapping ones made one."""
    first = F.lit(-1).cast("long")
    head = F.expr("cast(array() as array<struct<start:long,top:long>>)")
    step = lambda acc, x: F.struct(
        F.greatest(acc["top"], x["end"]).alias("top"), F.when(x["start"] >= acc["top"], F.concat(acc["out"], F.array(F.struct(x["start"].alias("start"), acc["top"].alias("top"))))).otherwise(acc["out"]).alias("out")
    )

    def joined(blocks):
        def over(tops):
            heads = F.flatten(F.transform(blocks, lambda own, i: F.aggregate(own, F.struct(F.coalesce(F.array_max(F.slice(tops, F.lit(1), i)), first).alias("top"), head.alias("out")), step, lambda acc: acc["out"])))
            # a span ends where the furthest of those before the next one does
            return let(heads, lambda h: F.transform(h, lambda x, i: F.struct(x["start"].alias("start"), F.coalesce(F.get(h, i + 1)["top"], F.array_max(tops)).alias("end"))))

        return let(F.transform(blocks, lambda own: F.array_max(F.transform(own, lambda x: x["end"]))), over)

    return let(_blocks(F.array_sort(spans)), joined)


def _shape(value: Column) -> Column:
    """Kinds of characters as they follow one another, and how many there are (of hexadecimal values, that alone)."""
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "9")
    bare = F.regexp_replace(value, "^[^0-9A-Za-z]+|[^0-9A-Za-z]+$", "")
    hexes = bare.rlike("^[0-9a-f]{16,}$") & bare.rlike("[a-f]")
    return F.concat(F.when(hexes, F.lit("hex")).otherwise(F.left(kinds, F.lit(64))), F.lit(":"), F.least(F.when(hexes, F.length(bare)).otherwise(F.length(value)), F.lit(99)).cast("string"))


def _units(run: Column) -> Column:
    """Instances of a run (start, end, instance, patterns, seed): its seeds, and the stretches of whole tokens before, between
    and after them. Of many seeds a block at a time, which works on its own part of the run's text."""
    part = lambda whole, left, right: F.substring(whole["value"], (left - whole["start"] + 1).cast("int"), (right - left).cast("int"))

    def block(own, b, blocks):
        count, final = F.size(own), b == F.size(blocks) - 1
        begin = F.when(b > 0, F.element_at(F.get(blocks, b - 1), -1)["end"]).otherwise(run["start"])
        close = F.when(final, run["end"]).otherwise(F.element_at(own, -1)["end"])

        def units(text):
            def stretch(i):
                left = F.when(i > 0, F.get(own, i - 1)["end"]).otherwise(text["start"])
                right = F.when(i < count, F.get(own, i)["start"]).otherwise(text["end"])

                def inside(gap):
                    # what is left of a seed's own tokens goes with the seed
                    after = F.when((b > 0) | (i > 0), F.regexp_replace(gap, r"^[^\x20\x09]++", "")).otherwise(gap)
                    mine = F.when(i < count, F.regexp_replace(after, r"(?<![^\x20\x09])[^\x20\x09]++\z", "")).otherwise(after)
                    value = F.regexp_extract(mine, f"({RUN})", 1)
                    start = left + F.length(gap) - F.length(after) + F.length(F.get(F.split(mine, RUN, 2), F.lit(0)))
                    return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"), ((b == 0) & (i == 0)).alias("first"), F.lit(False).alias("seed"))

                return let(part(text, left, right), inside)

            def every(rest):
                lone = (b == 0) & (F.length(F.get(rest, F.lit(0))["value"]) == 0)
                seeds = F.transform(own, lambda s, i: F.struct(s["start"].alias("start"), s["end"].alias("end"), part(text, s["start"], s["end"]).alias("value"), ((i == 0) & lone).alias("first"), F.lit(True).alias("seed")))
                return F.concat(seeds, F.filter(rest, lambda u: F.length(u["value"]) > 0))

            # a stretch before each seed; behind the last one of all, one more
            return let(F.transform(F.sequence(F.lit(0), F.when(final, count).otherwise(count - 1)), stretch), every)

        return let(F.struct(begin.alias("start"), close.alias("end"), part(run, begin, close).alias("value")), units)

    whole = F.array(F.struct(run["start"].alias("start"), run["end"].alias("end"), run["value"].alias("value"), F.lit(True).alias("first"), F.lit(False).alias("seed")))
    found = F.when(F.size(run["seeds"]) == 0, whole).otherwise(let(_blocks(run["seeds"]), lambda blocks: F.flatten(F.transform(blocks, lambda own, b: block(own, b, blocks)))))
    word = F.substring_index(run["left"], " ", -1)

    def patterns(u):
        # an instance that isn't its run's first stands behind another: #
        before = F.when(u["first"], F.array(F.concat(F.lit("2 "), run["left"]), F.concat(F.lit("1 "), word))).otherwise(F.array(F.ltrim(F.concat(F.lit("2 "), run["left"], F.lit(" #")))))
        between = F.when(u["first"] & (u["end"] == run["end"]) & (run["right"] != ""), F.array(F.concat(F.lit("- "), word, F.lit(" "), run["right"]))).otherwise(F.expr("cast(array() as array<string>)"))
        return F.concat(F.when(run["left"] != "", F.concat(before, between)).otherwise(F.expr("cast(array() as array<string>)")), F.array(F.concat(F.lit("s "), _shape(u["value"]))))

    return F.transform(found, lambda u: F.struct(u["start"].alias("start"), u["end"].alias("end"), F.sha1(u["value"].cast("binary")).alias("instance"), patterns(u).alias("patterns"), u["seed"].alias("seed")))


def _scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = lambda spans: F.transform(spans, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
    found = base_spans(F.col("text")) | {"secret": _if(F.col("text").rlike("[0-9A-Fa-f]{32}"), _matches(F.col("text"), SECRET))}
    rows = rows.select("id", F.monotonically_increasing_id().alias("row"), *[own(s).alias(k) for k, s in found.items()], _if(F.col("text").rlike("[0-9@]"), _matches(F.col("text"), RUN)).alias("runs"))
    # the two words before the run, in lower case; # where it stands right behind another run; and the word after it
    spaced = lambda text: F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))
    left = lambda gap: spaced(F.regexp_extract(F.right(gap, F.lit(64)), r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]+)?[^\x20\x09-\x0D]+[\x20\x09-\x0D]*$", 0))
    right = lambda gap: spaced(F.regexp_extract(F.left(gap, F.lit(64)), r"^[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", 0))
    overlap = lambda m: lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])
    clipped = lambda m: lambda b: F.struct(F.greatest(b["start"], m["start"]).alias("start"), F.least(b["end"], m["end"]).alias("end"))

    def run(m, seeds):
        return F.struct(
            m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"), let(left(m["before"]), lambda own: F.when((m["start"] > F.length(m["before"])) & (own == ""), F.lit("#")).otherwise(own)).alias("left"),
            right(m["after"]).alias("right"), F.transform(F.filter(seeds, overlap(m)), clipped(m)).alias("seeds"),
        )

    def block(seeds):
        # seeds are looked for in a block of runs first, then run by run
        near = lambda own: F.filter(seeds, lambda b: (b["start"] < F.element_at(own, -1)["end"]) & (F.get(own, F.lit(0))["start"] < b["end"]))
        return lambda own: let(near(own), lambda few: F.flatten(F.transform(own, lambda m: let(run(m, few), _units))))

    units = let(_merged(F.concat(*[F.col(k) for k in SEEDS])), lambda seeds: F.flatten(F.transform(_blocks(F.col("runs")), block(seeds))))
    none = F.expr("cast(array() as array<struct<start:long,end:long,instance:string,patterns:array<string>,seed:boolean>>)")
    return written(rows.select("id", "row", *SEEDS, F.when(F.size("runs") > 0, units).otherwise(none).alias("units")), "pii-scan")


def _discovered(scan: DataFrame) -> DataFrame:
    """row, start, end of unseen identifiers. Edges are counted before they move, and a pattern's edges meet its score in
    SALTS parts; an instance in very many patterns is left to the engine's skew join."""
    seen = scan.select("row", F.explode("units").alias("t")).select("row", "t.start", "t.end", "t.instance", "t.seed", F.explode("t.patterns").alias("pattern"))
    edges = written(seen.groupBy("pattern", "instance").agg(F.max(F.col("seed").cast("double")).alias("seed")).withColumn("salt", F.pmod(F.xxhash64("instance"), F.lit(SALTS))), "pii-edges")
    trust = edges.groupBy("instance").agg(F.max("seed").alias("trust"))
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    for _ in range(ROUNDS):
        marked = edges.join(trust, "instance")
        score = marked.groupBy("pattern").agg((F.sum("trust") / (F.count(F.lit(1)) + 1)).alias("score"), F.sum((F.col("trust") >= MIN_SCORE).cast("long")).alias("support"))
        score = written(score.where((F.col("support") >= MIN_SUPPORT) & (F.col("score") > 0)), "pii-patterns")
        # an instance is trusted by noisy-or over the patterns it stands in; seeds stay trusted
        linked = edges.join(score.select("pattern", "score", spread), ["pattern", "salt"], "left").groupBy("instance").agg(F.max("seed").alias("seed"), F.sum(F.log(1 - F.least(F.coalesce("score", F.lit(0.0)), F.lit(0.999)))).alias("doubt"))
        trust = written(linked.select("instance", F.greatest("seed", 1 - F.exp("doubt")).alias("trust")), "pii-instances")
    good = score.where(F.col("score") >= MIN_SCORE).select("pattern", spread)
    unseen = seen.where(~F.col("seed")).withColumn("salt", F.pmod(F.xxhash64("instance"), F.lit(SALTS)))
    return unseen.join(good, ["pattern", "salt"], "left_semi").select("row", "start", "end").distinct()


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, email, ip, card, phone, secret, identifier (arrays of start and end in code points, end
    exclusive, by start).

    A null text is empty and has no spans. Rows may repeat ids; each has its own result. Spans of different kinds may
    overlap; a discovered identifier overlaps no base span. Empty tables give empty results; other columns are ignored.
    """
    scan = _scan(docs, id_col, text_col)
    more = _discovered(scan).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("identifier"))
    return scan.drop("units").join(more, "row", "left").drop("row").withColumn("identifier", F.coalesce("identifier", F.expr(f"cast(array() as {_SPAN})"))).withColumnRenamed("id", id_col)


def _joined(kinds: dict[str, str]) -> Column:
    def each(kind: str, column: str) -> Column:
        return F.transform(F.col(column), lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    return F.array_join(F.concat(*[each(k, c) for k, c in kinds.items()]), ",")


def query(spark, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    base = {k: k for k in KINDS}
    every = base | {"secret": "secret", "id": "identifier"}
    total = sum((F.size(c) for c in every.values()), F.lit(0)).cast("long")
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(every).alias("spans"),
        F.size("secret").cast("long").alias("n_secret"), F.size("identifier").cast("long").alias("n_id"), total.alias("n_spans"),
    )


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with each base span replaced by its kind in brackets, of overlapping ones together the first (by start, then kind
    as listed). Other columns stay, nulls stay null, empty texts and tables empty, rows that repeat an id are rows of their
    own. The time is a text's length times its spans."""
    text, order = F.col(text_col), F.array(*[F.lit(k.upper()) for k in KINDS])
    own = lambda spans, kind: F.transform(spans, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))
    every = F.concat(*[own(s, i) for i, s in enumerate(base_spans(text).values())])

    def replaced(spans):
        def piece(m, i, merged):
            since = F.when(i > 0, F.get(merged, i - 1)["end"]).otherwise(F.lit(0).cast("long"))
            kind = F.array_min(F.filter(spans, lambda b: (b["start"] == m["start"])))["kind"]
            return F.concat(F.substring(text, (since + 1).cast("int"), (m["start"] - since).cast("int")), F.lit("["), F.get(order, kind), F.lit("]"))

        plain = F.transform(spans, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
        return let(_merged(plain), lambda merged: F.concat(F.array_join(F.transform(merged, lambda m, i: piece(m, i, merged)), ""), F.substring(text, (F.coalesce(F.element_at(merged, -1)["end"], F.lit(0)) + 1).cast("int"), F.length(text))))

    return docs.withColumn(text_col, F.when(text.isNotNull(), let(every, lambda spans: F.when(F.size(spans) == 0, text).otherwise(replaced(spans)))))
