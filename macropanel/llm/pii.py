"""PII, native: seed entities by pattern, then bootstrapped contextual extraction. DataFrame functions only.

Base entities (email, ip, card, phone) are found by regular expressions over whole texts. Their places come
from the lengths of what lies between the matches, so no Python counts characters.

They seed the bootstrap, and so do secrets: candidates of at least 20 hex digits, letters among them, that are
assigned to a key, token, secret or password; secrets are found spans of kind ``id``, not base spans. Lexical
patterns are the two words before an entity, the word before with the word after, and, for values with a letter and
a digit, the one word before (with what stands between) together with the shape of the value; a context without any
word is none. Values of digits alone have no such wider pattern: most are cards that fail their check. A bipartite
graph ties patterns to instances: the seeds, and candidates (identifier-shaped strings of 6 characters or more with a
digit, in one piece or in spaced groups that each hold a digit, that overlap no base span). Each round scores a pattern by
its distinct instances: the believed ones against those known to be none (dates, versions, and numbers of a card's
length that fail its check), an instance that nothing is known of counting ``unknown`` of one. A candidate is believed
as its best pattern is scored; a pattern counts once ``min_support`` distinct believed instances support it. So a few
values that stand in a known context and in a new one make the new one a pattern, and what else stands there is found,
which no seed expression names. After ``rounds`` rounds, candidates that are believed by ``confidence`` or more are
spans of kind ``id``, wherever their value stands; what is known to be none is never believed.

The expressions are the plain ones made safe for any text: possessive repeats and looks behind give the same
leftmost matches without trying every start of a long run, and without deep recursion.

Defined results: null and empty texts have no spans (base_sha256 is that of the empty string, spans is empty);
rows that repeat a (doc_id, text) pair get the same spans; a value that stands in many texts is one instance;
an empty table gives an empty result; only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macropanel.llm.common import Scratch, text_key, whole

KINDS = ("email", "ip", "card", "phone")
#: In the order of KINDS; each finds what its plain form finds:
#: email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+   ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#: card [0-9]([\x20-]?[0-9])+ of 16 to 19 digits              phone \+[0-9][\x20().0-9-]+[0-9]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to be looked for at all.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: An identifier-shaped string: 6 characters or more with a digit, set off by white space, quotes, brackets or = and :, or closed by a quote.
#: First in spaced groups of capitals and digits (a digit in each, a letter in the first), else in one piece.
GROUP = r"(?=[A-Z]{0,6}+[0-9])[A-Z0-9]{2,8}+"
CANDIDATE = (
    r"(?<![^\s=:\"'(<\[])(?:(?=[0-9]{0,8}+[A-Z])" + GROUP + r"(?:\x20" + GROUP + r")+(?=[.,;:!?)>\]\"']*+(?:\s|$)|[\"'])"
    r"|(?=[A-Za-z@._+/#-]*+[0-9])[A-Za-z0-9][A-Za-z0-9@._+/#-]{4,}[A-Za-z0-9](?=[.,;:!?)>\]\"']*+(?:\s|$)|[\"']))"
)
#: What a secret is assigned to, as the (lower case) text before it ends, and what it looks like.
ASSIGNED = r"(?:key|token|secret|password|passwd|pwd)[\"']?\s*+[=:]\s*+[\"']?$"
SECRET = r"^(?=[0-9]*+[A-Fa-f])[0-9A-Fa-f]{20,}$"
#: Values that are known to be no identifiers: dates, versions, and numbers of a card's length (those that pass its check are base spans).
NONE = r"^(?:[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}(?:T.*+)?|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{2,4}|[vV]?[0-9]++(?:\.[0-9]++)++(?:[-+].*+)?|[0-9](?:[\x20-]?[0-9]){15,18}+)$"
#: What an instance that nothing is known of counts against a pattern, as part of one known to be none.
UNKNOWN = 0.01
#: Code points on either side in which context words are sought.
CONTEXT = 80
ROUNDS = 3
MIN_SUPPORT = 3
CONFIDENCE = 0.8
#: Parts that a pattern's edges are dealt over.
SALTS = 16

SPANS = "array<struct<start:int,end:int,value:string>>"


def places(matches: Column, gaps: Column) -> Column:
    """Matches with start and end in code points, from the texts between them."""
    pairs = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + x["gap"]
        b = a + F.length(x["m"])
        one = F.array(F.struct(a.alias("start"), b.alias("end"), x["m"].alias("value"))).cast(SPANS)
        return F.struct(b.alias("at"), F.concat(acc["out"], one).alias("out"))

    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + worth(i)) % 10 == 0


def holds(kind: str, value: Column) -> Column:
    """Whether a match passes its kind's check."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.rlike(p, F.lit("^0*+(?:|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")))
    if kind == "card":
        return luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def shape(value: Column) -> Column:
    """Coarse: for letters and digits alone (hex or not) the band of the length, 6 to 11, 12 to 23 and so on; else the signs with w for what stands between."""
    band = F.floor(F.log2(F.greatest(F.length(value), F.lit(6)) / 6.0)).cast("string")
    signs = F.regexp_replace(value, "[A-Za-z0-9]+", "w")
    return F.when(signs == "w", F.concat(F.lit("word"), band)).otherwise(signs)


def _words(kind: Column, text: Column, span: Column) -> Column:
    """The span with its context: the two words before, the word before with the word after, the word before with the shape; and whether it is a secret."""
    ahead = F.lower(F.substring(text, F.greatest(span["start"] - CONTEXT, F.lit(0)) + 1, span["start"] - F.greatest(span["start"] - CONTEXT, F.lit(0))))
    before = F.split(F.rtrim(ahead), r"\s+")
    after = F.split(F.ltrim(F.lower(F.substring(text, span["end"] + 1, F.lit(CONTEXT)))), r"\s+")
    last, second = F.get(before, F.size(before) - 1), F.get(before, F.size(before) - 2)
    value = span["value"]
    worded = F.regexp_extract(F.rtrim(ahead), r"[\p{L}\p{N}_]++[^\p{L}\p{N}_]*+$", 0)
    mixed = F.rlike(value, F.lit("[A-Za-z]")) & F.rlike(value, F.lit("[0-9]")) & (worded != "")
    return F.struct(
        kind.alias("kind"), span["start"].alias("start"), span["end"].alias("end"), span["value"].alias("value"),
        F.concat_ws(" ", second, last).alias("left"), F.concat_ws(" _ ", last, F.get(after, F.lit(0))).alias("around"),
        F.when(mixed, F.concat_ws("|", worded, shape(value))).alias("worded"),
        ((kind == "id") & F.rlike(value, F.lit(SECRET)) & F.rlike(ahead, F.lit(ASSIGNED))).alias("secret"),
    )


def extract(docs: DataFrame) -> DataFrame:
    """doc_id, key, base (spans by kind and start) and candidates (identifier-shaped strings that overlap none), with contexts."""
    some = F.rlike("text", F.lit("[0-9@]"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), whole().alias("text"))
    d = d.withColumn("some", some)
    none = F.array().cast("array<string>")
    all_ = PATTERNS | {"candidate": CANDIDATE}

    def when(kind: str) -> Column:
        hint = HINTS.get(kind)
        return F.col("some") & F.contains("text", F.lit(hint)) if hint else F.col("some")

    d = d.select("*", *[F.when(when(k), F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none).alias(f"m_{k}") for k, p in all_.items()])
    d = d.select("*", *[F.when(F.size(f"m_{k}") > 0, places(F.col(f"m_{k}"), F.split("text", p, -1))).otherwise(F.array().cast(SPANS)).alias(f"s_{k}") for k, p in all_.items()])

    def valid(kind: str) -> Column:
        right = F.filter(f"s_{kind}", lambda s: holds(kind, s["value"]))
        return F.transform(right, lambda s: _words(F.lit(kind), F.col("text"), s))

    base = F.concat(*map(valid, KINDS))
    d = d.select("doc_id", "key", "text", "s_candidate", base.alias("base"))
    free = F.filter("s_candidate", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return d.select("doc_id", "key", "base", F.transform(free, lambda s: _words(F.lit("id"), F.col("text"), s)).alias("candidates"))


def bootstrap(marked: DataFrame, scratch: Scratch, rounds: int, min_support: int, confidence: float, unknown: float = UNKNOWN) -> DataFrame:
    """instance values (value, belief) of candidates that confident patterns believe in."""
    seen = F.explode(F.concat("base", "candidates")).alias("x")
    seed = ((F.col("x.kind") != "id") | F.col("x.secret")).cast("double")
    patterns = F.array(F.concat(F.lit("<"), "x.left"), F.concat(F.lit("="), "x.around"), F.concat(F.lit("w"), "x.worded"))
    # by a pattern of signs alone any quoted value would be taken; a value without patterns keeps one of its own
    patterns = F.filter(patterns, lambda p: F.rlike(F.substring(p, 2, 2**30), F.lit(r"[\p{L}\p{N}]")))
    patterns = F.when(F.size(patterns) > 0, patterns).otherwise(F.array(F.concat(F.lit("!"), "x.value")))
    none = ((seed == 0) & F.rlike("x.value", F.lit(NONE))).alias("none")
    each = marked.select(seen).select(F.col("x.value").alias("value"), seed.alias("seed"), none, F.explode(patterns).alias("pattern"))
    salt = F.pmod(F.xxhash64("value"), F.lit(SALTS)).cast("int").alias("salt")
    edges = scratch.save(each.groupBy("pattern", "value").agg(F.max("seed").alias("seed"), (F.max("none") & (F.max("seed") == 0)).alias("none")).select("*", salt), "edges")
    belief = scratch.save(edges.groupBy("value").agg(F.max("seed").alias("belief")), "belief-0")
    for k in range(1, rounds + 1):
        known = edges.join(belief.select(F.col("value").alias("_v"), "belief"), F.col("value") == F.col("_v")).drop("_v")
        held = F.when(F.col("belief") >= confidence, F.col("belief")).otherwise(0.0)
        against = F.when(F.col("none"), 1.0).when(held > 0, 1.0 - held).otherwise(unknown)
        score = known.groupBy("pattern").agg(F.sum(F.when(held > 0, 1).otherwise(0)).alias("support"), (F.sum(held) / (F.sum(held) + F.sum(against))).alias("score"))
        # a pattern as common as a third of all edges meets its score in SALTS tasks
        score = score.where(F.col("support") >= min_support).select(F.col("pattern").alias("_p"), "score", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
        best = edges.join(score, (F.col("pattern") == F.col("_p")) & (F.col("salt") == F.col("_s")), "left").groupBy("value").agg(F.max("seed").alias("seed"), F.max("score").alias("score"), F.max("none").alias("none"))
        belief = scratch.save(best.select("value", F.when(F.col("seed") == 1, 1.0).when(F.col("none"), 0.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("belief")), f"belief-{k}")
        scratch.drop(f"belief-{k - 1}")
    scratch.drop("edges")
    return belief.where(F.col("belief") >= confidence)


def find_pii(docs: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """doc_id, key, base (array of spans) and found (array of spans of kind id): a row per document."""
    scratch = Scratch(docs.sparkSession, "pii")
    marked = scratch.save(extract(docs), "marked")
    believed = bootstrap(marked, scratch, rounds, min_support, confidence).select(F.col("value").alias("_v"))
    at = marked.select("doc_id", "key", F.explode("candidates").alias("x")).join(believed, F.col("x.value") == F.col("_v"), "left_semi")
    new = at.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set(F.struct("x.start", "x.end", "x.value", "x.kind"))).alias("found"))
    new = new.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), "found")
    out = marked.join(new, (F.col("key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left")
    none = F.array().cast("array<struct<start:int,end:int,value:string,kind:string>>")
    return out.select("doc_id", "key", F.transform("base", lambda s: F.struct(s["start"], s["end"], s["value"], s["kind"])).alias("base"), F.coalesce("found", none).alias("found"))


def query(spark, sf_dir: str) -> DataFrame:
    """op9: counts by kind, the digest of the base spans and all spans of every document."""
    p = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    said = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return p.select("doc_id", *map(count, KINDS), F.sha2(said(F.col("base")).cast("binary"), 256).alias("base_sha256"), said(F.concat("base", "found")).alias("spans"))
