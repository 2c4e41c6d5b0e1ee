"""Secret scanning with fixed patterns and character Markov models, in SQL functions.

Three fixed kinds (assign, access, hex) come from patterns.  A fourth, ``markov``,
is added for tokens of ``LEAST`` or more characters outside those: two first-order
character models, one of random strings and one of ordinary identifiers, are trained
from labelled samples and a token is a secret if the log-likelihood ratio favours the
random one.

Spark has no function for the places of matches, so they follow from lengths: the
text between matches (``split``) and the matches themselves (``regexp_extract_all``)
alternate, and a match ends where the sum of all lengths up to it does.  The sums are
taken by doubling strides, so a text of many matches costs little more than linear time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: What the models look at: runs of so many token characters.
LEAST = 12
TOKEN = r"[A-Za-z0-9+/_=-]{12,}"
KINDS = ("assign", "access", "hex", "markov")
#: Documents in the sample of ordinary identifiers, and random strings, of each form.
SAMPLE_DOCS, SAMPLE_RANDOM = 4000, 2000
#: A token is a secret if the ratio, in nats, exceeds both.
TOTAL, PER_CHARACTER = 10.0, 0.5
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: The token characters lie between these code points.
_LOW, _SPAN = 43, 80
#: Names of columns that :func:`scan` makes on its way.
_OWN = ("_text", "_assign", "_access", "_hex", "_known", "_odd")
_MATCH = "array<struct<begin:int,end:int,match:string>>"


def _strides(text: Column) -> Column:
    """1, 2, 4 ... up to the length of the text."""
    return F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.length(text) + 1)).cast("int")), lambda k: F.pow(F.lit(2), k).cast("int"))


def _found(text: Column, pattern: str) -> Column:
    """``array<struct<begin, end, match>>`` of the leftmost non-overlapping matches,
    in code points, end exclusive."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(gaps, hits, lambda g, h: F.struct((F.length(g) + F.length(h)).alias("end"), h.alias("match")))
    steps = F.filter(steps, lambda x: x["match"].isNotNull())  # what follows the last match
    summed = F.aggregate(
        _strides(text), steps, lambda a, d: F.transform(a, lambda x, i: F.struct((x["end"] + F.when(i >= d, F.get(a, i - d)["end"]).otherwise(0)).alias("end"), x["match"].alias("match")))
    )
    return F.transform(summed, lambda x: F.struct((x["end"] - F.length(x["match"])).alias("begin"), x["end"].alias("end"), x["match"].alias("match")))


def _none() -> Column:
    return F.array().cast(_MATCH)


def _once(docs: DataFrame, **columns: Column) -> DataFrame:
    """Adds computed columns, each evaluated once a row, whatever mentions it later."""
    return docs.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def _apart(spans: Column, known: Column, text: Column) -> Column:
    """The spans that overlap none of ``known``.  All are put in order; a span overlaps if
    a known one before it ends behind its begin, or one after it begins before its end."""
    least = F.lit(2**31 - 1)
    one = lambda x, own, end, begin: F.struct(x["begin"].alias("begin"), x["end"].alias("end"), own.alias("own"), end.alias("before"), begin.alias("after"))
    both = F.array_sort(F.concat(F.transform(spans, lambda x: one(x, F.lit(True), F.lit(0), least)), F.transform(known, lambda x: one(x, F.lit(False), x["end"], x["begin"]))))
    step = lambda a, d: F.transform(
        a,
        lambda x, i: F.struct(
            x["begin"].alias("begin"), x["end"].alias("end"), x["own"].alias("own"),
            F.greatest(x["before"], F.when(i >= d, F.get(a, i - d)["before"])).alias("before"), F.least(x["after"], F.get(a, i + d)["after"]).alias("after"),
        ),
    )
    free = F.filter(F.aggregate(_strides(text), both, step), lambda x: x["own"] & (x["before"] <= x["begin"]) & (x["after"] >= x["end"]))
    free = F.transform(free, lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end"), F.lit(None).cast("string").alias("match")))
    return F.when((F.size(spans) == 0) | (F.size(known) == 0), spans).otherwise(free)


def _tagged(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(spans, lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind")))


def with_base(docs: DataFrame) -> DataFrame:
    """Adds ``_text`` (null: empty), ``_assign, _access, _hex`` and ``_known``, all
    spans of these kinds.  The costly expressions run only where a match is."""
    text = F.col("_text")
    kept = lambda pattern: F.when(text.rlike(pattern), _found(text, pattern)).otherwise(_none())
    long_enough = lambda a: F.filter(a, lambda x: F.length(F.regexp_extract(x["match"], ASSIGN, 1)) >= 12)
    based = _once(docs.withColumn("_text", F.coalesce(F.col("text"), F.lit(""))), _assign=long_enough(kept(ASSIGN)), _access=kept(ACCESS), _hex=kept(HEX))
    return based.withColumn("_known", F.concat("_assign", "_access", "_hex"))


def _pair_counts(strings: DataFrame, label: str) -> DataFrame:
    """Counts of the pairs of neighbouring characters, summed before the shuffle."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substring(F.col("s"), i, F.lit(2)))
    return strings.where(F.length("s") > 1).select(F.explode(pairs).alias("pair")).groupBy("pair").count().select(F.lit(label).alias("label"), "pair", "count")


def _identifier(a: Column, b: Column, i: Column) -> Column:
    """Two neighbouring words written as one identifier, in a style by their place; one of
    the styles is a rule, a run of one character."""
    number = F.pmod(F.xxhash64(a, b), F.lit(1000000)).cast("string")
    date = F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), F.pmod(F.xxhash64(a), F.lit(15000)).cast("int")), "yyyy-MM-dd")
    styles = [
        F.concat(a, F.lit("_"), b), F.concat(F.upper(a), F.lit("_"), F.upper(b)), F.concat(F.initcap(a), F.initcap(b)), F.concat(a, F.initcap(b)), F.concat(a, F.lit("-"), b),
        F.concat(a, F.lit("/"), b), F.concat(a, number), F.concat(F.upper(a), F.lit("-"), number), F.repeat(F.substring(F.lit(_ALPHABET), F.pmod(F.xxhash64(b), F.lit(len(_ALPHABET))).cast("int") + 1, F.lit(1)), 12), date,
    ]
    out = styles[-1]
    for k, style in enumerate(styles[:-1]):
        out = F.when(i % len(styles) == k, style).otherwise(out)
    return out


def fit(docs: DataFrame) -> dict[str, float]:
    """The log-likelihood ratio of each pair of characters, random over ordinary.

    Random strings are labelled by how they are made (digests of numbers in hex, base64,
    its URL form, and in one case); ordinary identifiers are the words of a hash sample
    of about ``SAMPLE_DOCS`` documents without any fixed-kind secret, and neighbouring
    words of letters joined in the usual styles.  Counts are add-one smoothed over the 67
    token characters; the model is at most 67 * 67 numbers.  An empty corpus leaves a
    uniform ordinary model.
    """
    spark = docs.sparkSession
    n = docs.count()
    part = docs.where(F.pmod(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))), F.lit(1 << 30)) < F.lit(min(1.0, SAMPLE_DOCS / max(1, n)) * (1 << 30)))
    part = with_base(part.select("text")).where(F.size("_known") == 0)
    words = part.select(F.explode(F.regexp_extract_all("_text", F.lit("[A-Za-z0-9+/_=-]+"), F.lit(0))).alias("s")).where("length(s) > 2")
    letters = _once(part.select("_text"), w=F.regexp_extract_all("_text", F.lit("[A-Za-z]{2,}"), F.lit(0)))
    pairs = F.zip_with("w", F.slice("w", 2, F.size("w")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    made = letters.select(F.posexplode(pairs).alias("i", "x")).where("x.b is not null").select(_identifier(F.col("x.a"), F.col("x.b"), F.col("i")).alias("s"))
    digest = F.sha2(F.col("id").cast("string"), 256)
    coded = F.base64(F.unhex(digest))
    random = spark.range(SAMPLE_RANDOM, numPartitions=1).select(
        F.explode(F.array(digest, coded, F.translate(coded, "+/=", "-_"), F.translate(F.upper(coded), "+/=", ""), F.translate(F.lower(coded), "+/=", ""))).alias("s")
    )
    counts: dict[str, dict[str, int]] = {"random": {}, "ordinary": {}}
    for r in _pair_counts(random, "random").unionAll(_pair_counts(words.unionAll(made), "ordinary")).collect():
        counts[r["label"]][r["pair"]] = r["count"]
    out = {}
    for a in _ALPHABET:
        total = {k: sum(v.get(a + b, 0) for b in _ALPHABET) for k, v in counts.items()}
        for b in _ALPHABET:
            p = {k: (v.get(a + b, 0) + 1) / (total[k] + len(_ALPHABET)) for k, v in counts.items()}
            out[a + b] = math.log(p["random"] / p["ordinary"])
    return out


def _table(ratios: dict[str, float]) -> Column:
    """The ratios as one constant array, by the places of both characters."""
    cells = [f"{ratios.get(chr(_LOW + a) + chr(_LOW + b), 0.0):.6f}" for a in range(_SPAN) for b in range(_SPAN)]
    return F.split(F.lit(",".join(cells)), ",").cast("array<double>")


def _ratio(token: Column, table: Column) -> Column:
    """The log-likelihood ratio of a token, character by character."""
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    place = lambda c: F.ascii(c) - _LOW
    step = lambda s, c: F.when(c == "", s).otherwise(
        F.struct(place(c).alias("last"), (s["sum"] + F.when(s["last"] >= 0, F.get(table, s["last"] * _SPAN + place(c))).otherwise(0.0)).alias("sum"))
    )
    return F.aggregate(F.split(token, ""), start, step, lambda s: s["sum"])


def scan(docs: DataFrame, ratios: dict[str, float] | None = None) -> DataFrame:
    """``docs`` with ``spans``: ``array<struct<begin, end, rank, kind>>`` of all kinds,
    by begin, then kind.  Nothing is shuffled.

    Null and empty texts have no spans.  Offsets are code points of the whole text,
    end exclusive.  A ``markov`` span never overlaps a fixed one.
    """
    table = _table(fit(docs) if ratios is None else ratios)
    given = {c: f"_given{c}" for c in _OWN if c in docs.columns}
    docs = docs.withColumnsRenamed(given)
    text = F.col("_text")
    tokens = F.when(text.rlike(TOKEN), _found(text, TOKEN)).otherwise(_none())
    random = lambda x: (lambda r: (r > TOTAL) & (r > PER_CHARACTER * (x["end"] - x["begin"])))(_ratio(x["match"], table))
    based = _once(with_base(docs), _odd=F.filter(tokens, random))
    markov = _apart(F.col("_odd"), F.col("_known"), text)
    named = [_tagged(c, i, k) for i, (k, c) in enumerate(zip(KINDS, (F.col("_assign"), F.col("_access"), F.col("_hex"), markov)))]
    by = lambda a: F.transform(F.array_sort(F.transform(a, lambda x: F.struct(x["begin"].alias("begin"), x["rank"].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")))), lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end"), x["rank"].alias("rank"), x["kind"].alias("kind")))
    return based.withColumn("spans", by(F.concat(*named))).drop(*_OWN).withColumnsRenamed({v: k for k, v in given.items()})


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["begin"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark`` and ``n_chars``, where
    there is one, brought in line.  Overlapping spans become one mark; texts without
    spans, null texts too, and all other columns stay as they are."""
    cols = docs.columns
    own = docs.withColumnsRenamed({"spans": "_given_spans"}) if "spans" in cols else docs
    found = scan(own)
    step = lambda s, x: F.struct(
        F.greatest(s["at"], x["end"]).alias("at"),
        F.when(x["begin"] >= s["at"], F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, x["begin"] - s["at"]), F.lit(mark))).otherwise(s["out"]).alias("out"),
    )
    clean = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    out = found.withColumn("text", F.when(F.size("spans") > 0, clean).otherwise(F.col("text")))
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    out = out.drop("spans")
    return (out.withColumnRenamed("_given_spans", "spans") if "spans" in cols else out).select(cols)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.filter("spans", lambda x: x["rank"] < 3)
    count = lambda i: F.size(F.filter("spans", lambda x: x["rank"] == i)).cast("long")
    return scan(docs).select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
