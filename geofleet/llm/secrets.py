"""Operator 7: secrets by corpus-wide ownership frequency. DataFrame functions only.

Candidates are the base patterns' matches, those of a vendor pattern (private keys from header to footer, tokens with a maker's
prefix), and signed web tokens. A private key's secret is its body, without line breaks (real or escaped); a header without footer
stands for itself. Spans are found natively: every match is set between two marks by regexp_replace, the text is split at the marks, and running
lengths of the parts give the places. (The marks are control characters that no pattern can match; a text's own are replaced by a
third such character of the same length beforehand.)

Each candidate's secret value is hashed, and the hash is counted over distinct repositories and owners in the whole
corpus; of one owner's equal texts, one repository counts. Owners decide: a value of ``copied_owners`` owners is an example that people
copy; ``copied_repos`` repositories support this from two owners on, but of one owner they never make a credential an example. A value of
fewer that looks random is taken for live; the rest is unclear. Hashes, not values, leave the scan.

An assigned value that looks random is also found where it stands bare, anywhere in the corpus: as a whole run of its characters ("="
divides runs), punctuation at the ends of run and value left aside. Such a span is of kind ``known`` if no pattern's span holds it, and its
owner and repository count. (A value with "=" inside is found where it is assigned only.)

Counting combines by (text, hash, owner), then (hash, owner) first, and documents look the result up by (hash, salt), so
a value found in a third of all rows is no hot key.

Defined results: a null text counts as empty: no spans; a null owner or repository counts as no owner or repository; repeated rows are
one row each and count as one text; empty input gives no rows; extra columns are ignored; an empty list of spans is an empty string, and base_sha256 that of the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geofleet.llm.common import cut, salted_lookup

#: Kind, pattern, group that holds the secret, its least length. Fixed patterns.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
)
#: A private key's body is all up to the next five dashes.
VENDOR = ("vendor", r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*+(?:-{1,4}+[^-]++)*+-----END [A-Z ]*PRIVATE KEY-----)?"
                    r"|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1)
JWT = ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 1)
KINDS = (*BASE, VENDOR, JWT)
#: The number of spans of values that are known from elsewhere, and the names of all kinds.
KNOWN = len(KINDS)
NAMES = (*(k[0] for k in KINDS), "known")
#: Runs that may hold a known value: 16 characters or more, with a digit and a letter. A run is looked at from its start only.
BARE = r"(?<![A-Za-z0-9+/_.-])(?=[A-Za-z+/_.-]*+[0-9])(?=[0-9+/_.-]*+[A-Za-z])[A-Za-z0-9+/_.-]{16,}+"
ENDS = "+/_.=-"
#: The spans of JWT in linear time: a run of its characters is looked at from its start only, once it is known that the two parts
#: after it fit; group 1 is what comes before the run's first "eyJ" with enough behind it, group 2 the match.
JWT_RUNS = (r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]++\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-])((?:(?!eyJ[A-Za-z0-9_-]{8})[A-Za-z0-9_-])*+)"
            r"(eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++)")
#: Patterns by which a text is sorted out, or matched with the same spans, at less cost. An unbroken run of hex digits is
#: one match at any length, and so is what follows AKIA, so the least length can be asked for in the pattern.
QUICK = {"access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}
COPIED_OWNERS = 3
COPIED_REPOS = 10
OPEN, CLOSE, OTHER = "\x01", "\x02", "\x03"
STEP = 256


def _running(lengths: Column) -> Column:
    """Sums of the lengths before each element. In chunks: a fold that appends copies what it has so far."""
    start = lambda: F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("before"))
    add = lambda s, x: F.struct((s["total"] + x).alias("total"), F.concat(s["before"], F.array(s["total"])).alias("before"))
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / STEP).cast("int")), lambda k: F.aggregate(
        F.slice(lengths, k * STEP + 1, F.lit(STEP)), start(), add))
    bases = F.aggregate(parts, start(), lambda s, p: F.struct((s["total"] + p["total"]).alias("total"), F.concat(s["before"], F.array(s["total"])).alias("before")))["before"]
    return F.flatten(F.transform(F.arrays_zip(parts.alias("p"), bases.alias("b")), lambda z: F.transform(z["p"]["before"], lambda x: x + z["b"])))


def matches(df: DataFrame, text: str, pattern: str, out: str, marked: str = f"{OPEN}$0{CLOSE}") -> DataFrame:
    """``df`` with ``out``: array<struct<start, end, match>> of the pattern's leftmost non-overlapping matches, in code points.

    ``text`` names a column without the marks; ``marked`` is a match set between them.
    """
    found = F.regexp_replace(F.col(text), F.lit(pattern), F.lit(marked))
    parts = F.when(F.col(text).rlike(pattern), F.split(found, f"[{OPEN}{CLOSE}]", -1))
    spans = F.transform(F.sequence(F.lit(1), F.size("_parts") - 2, F.lit(2)), lambda i: F.struct(
        F.get("_before", i).alias("start"), (F.get("_before", i) + F.length(F.get("_parts", i))).alias("end"), F.get("_parts", i).alias("match")))
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    return (df.withColumn("_parts", parts)
            .withColumn("_before", F.when(F.col("_parts").isNotNull(), _running(F.transform("_parts", F.length))))
            .withColumn(out, F.when(F.col("_parts").isNotNull(), spans).otherwise(none)).drop("_parts", "_before"))


def _found(docs: DataFrame) -> DataFrame:
    """docs(doc_id, repo, owner, text) -> row, doc_id, repo, owner, digest, spans array<struct<start, kind, end, hash, random, core>>,
    bare array<struct<start, end, core>>, the runs that may hold a known value."""
    marked = docs.withColumn("digest", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))).withColumn(
        "_text", F.translate(F.coalesce("text", F.lit("")), OPEN + CLOSE, OTHER * 2)).drop("text")
    for kind, pattern, _, _ in KINDS:
        if kind == JWT[0]:
            marked = matches(marked, "_text", JWT_RUNS, f"_{kind}", f"$1{OPEN}$2{CLOSE}")
        else:
            marked = matches(marked, "_text", QUICK.get(kind, pattern), f"_{kind}")
    marked = matches(marked, "_text", BARE, "_bare")
    spans = [_held(F.col(f"_{kind}"), n, pattern, group, least) for n, (kind, pattern, group, least) in enumerate(KINDS)]
    return marked.select(F.monotonically_increasing_id().alias("row"), "doc_id", "repo", "owner", "digest", F.array_sort(F.concat(*spans)).alias("spans"), _cores(F.col("_bare")).alias("bare"))


def _key(value: Column) -> Column:
    """A private key's body without what breaks its lines; any other match, a header alone or a key without body as it is."""
    body = F.regexp_replace(F.regexp_replace(value, "-----[A-Z ]+-----", ""), r"\\[nr]|[^A-Za-z0-9+/=]", "")
    return F.when(value.startswith("-----BEGIN ") & value.contains("-----END ") & (body != ""), body).otherwise(value)


def _cores(found: Column) -> Column:
    """Runs without the punctuation at their ends, if they look random: array<struct<start, end, core>>."""
    trimmed = F.transform(found, lambda m: F.struct((m["end"] - F.length(F.ltrim(m["match"], F.lit(ENDS)))).alias("start"), F.btrim(m["match"], F.lit(ENDS)).alias("value")))
    return F.transform(F.filter(trimmed, lambda x: looks_random(x["value"])), lambda x: F.struct(
        x["start"].alias("start"), (x["start"] + F.length(x["value"])).alias("end"), F.unhex(F.sha2(x["value"], 256)).alias("core")))


def _held(found: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Of the matches of one kind, those with a secret of the least length: array<struct<start, kind, end, hash, random, core>>.
    The core is the hash by which an assigned value is found where it stands bare."""
    secret = lambda m: F.regexp_extract(m, pattern, group) if group else _key(m) if kind == KINDS.index(VENDOR) else m
    held = F.transform(found, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), secret(m["match"]).alias("value")))
    return F.transform(F.filter(held, lambda x: F.length(x["value"]) >= least), lambda x: F.struct(
        x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), F.unhex(F.sha2(x["value"], 256)).alias("hash"),
        looks_random(x["value"]).alias("random"), _core(x["value"], kind).alias("core")))


def _core(value: Column, kind: int) -> Column:
    """Only of assigned values; what the other patterns match they match wherever it stands."""
    if kind != 0:
        return F.lit(None).cast("binary")
    core = F.btrim(value, F.lit(ENDS))
    return F.when(looks_random(core) & ~core.contains("="), F.unhex(F.sha2(core, 256)))


def looks_random(value: Column) -> Column:
    """Letters and digits, 16 characters or more, 8 different ones at least."""
    different = F.size(F.array_distinct(F.split(value, "")))
    return (F.length(value) >= 16) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (different >= 8)


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, owners, repos) from (hash, owner, repo): how many distinct owners and repositories hold each value."""
    owned = candidates.distinct()
    owners = owned.where("owner is not null").groupBy("hash", "owner").agg(F.lit(1).alias("one")).groupBy("hash").agg(F.count("one").alias("owners"))
    repos = owned.where("repo is not null").groupBy("hash", "repo").agg(F.lit(1).alias("one")).groupBy("hash").agg(F.count("one").alias("repos"))
    return owners.join(repos, "hash", "full").select("hash", F.coalesce("owners", F.lit(0)).alias("owners"), F.coalesce("repos", F.lit(0)).alias("repos"))


def known_bare(found: DataFrame, each: DataFrame) -> DataFrame:
    """Rows like ``each`` for the runs of ``found`` that are values of an assignment elsewhere in the corpus.

    Of values that differ in the punctuation at their ends only, a run is the one without, else the one of least hash.
    """
    values = each.where("core is not null").groupBy("core").agg(F.min(F.struct((F.col("hash") != F.col("core")).alias("other"), "hash"))["hash"].alias("hash"))
    runs = found.select("row", "repo", "owner", "digest", F.explode("bare").alias("b")).select("row", "repo", "owner", "digest", "b.*")
    return salted_lookup(runs, values, "core", "row").where("hash is not null").select(
        "row", "repo", "owner", "digest", "start", F.lit(KNOWN).alias("kind"), "end", "hash", F.lit(True).alias("random"), "core")


def _unheld(each: DataFrame) -> DataFrame:
    """``each`` without the known values that stand within another span of their row."""
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    reach = each.withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(-1)))
    return reach.where((F.col("kind") < KNOWN) | (F.col("reach") < F.col("end"))).drop("reach")


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in NAMES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source",
         copied_owners: int = COPIED_OWNERS, copied_repos: int = COPIED_REPOS) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, n_unclear and
    findings array<struct<start, end, kind, hash, owners, repos, verdict>>."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(repo_col).cast("string").alias("repo"), F.col(owner_col).cast("string").alias("owner"),
                        F.col(text_col).alias("text"))
    found = cut(_found(named))
    each = found.select("row", "repo", "owner", "digest", F.explode("spans").alias("s")).select("row", "repo", "owner", "digest", "s.*")
    each = cut(_unheld(each.unionByName(known_bare(found, each))).drop("core"))
    texts = each.groupBy("digest", "hash", "owner").agg(F.min("repo").alias("repo"))
    counted = salted_lookup(each.drop("digest"), ownership(texts.select("hash", "owner", "repo")), "hash", "row")
    owners, repos = F.coalesce("owners", F.lit(0)), F.coalesce("repos", F.lit(0))
    verdict = F.when((owners >= copied_owners) | ((owners >= 2) & (repos >= copied_repos)), "copied").when(F.col("random"), "live").otherwise("unclear")
    names = F.array(*[F.lit(k) for k in NAMES])
    judged = counted.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "start", "end", F.get(names, F.col("kind")).alias("kind"), F.lower(F.hex("hash")).alias("hash"), owners.alias("owners"), repos.alias("repos"), verdict.alias("verdict")))).alias("findings"),
        F.collect_list(F.when(F.col("kind") == KNOWN, F.struct("start", "kind", "end"))).alias("known"))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    n_kind = lambda n: F.size(F.filter("spans", lambda s: s["kind"] == n)).cast("long")
    n_verdict = lambda v: F.coalesce(F.size(F.filter("findings", lambda x: x["verdict"] == v)), F.lit(0)).cast("long")
    spans = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    spans = F.when(F.size("known") > 0, F.array_sort(F.concat(spans, "known"))).otherwise(spans)
    return found.join(judged, "row", "left").select(
        "doc_id", *[n_kind(n).alias(f"n_{k[0]}") for n, k in enumerate(BASE)], F.sha2(_listed(base), 256).alias("base_sha256"), _listed(spans).alias("spans"),
        *[F.when(F.col("findings").isNull(), 0).otherwise(n_verdict(v)).cast("long").alias(f"n_{v}") for v in ("live", "copied", "unclear")], "findings")
