"""Secret scan: patterns find candidates, a random forest trained from labelled findings removes false ones.

Everything is DataFrame functions and Spark's own forest. A finding is the candidate with the text right before
and after it. Its features: length, character classes and the transitions between them, variety, coverage by
dictionary words, the path it comes from and the words next to it.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from breathline.llm.base import kept

# Documents that labelled findings are derived from, at most: some twenty findings each.
SAMPLE = 1000
CUT = 0.5
NEAR = 40

# Forms of candidates. A keyword with an assigned value, known key forms, a private key's header,
# or a long run of key characters with a digit in it. No form has an upper bound, so a key is one candidate whatever
# its length; the possessive quantifiers never give characters back, so a long run is read a fixed number of times.
CANDIDATE = (
    r"(?i:passwd|password|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?[ ]?[=:][ ]?[\"']?[^\s\"'<>|,;]{8,}+"
    r"|(?<![A-Za-z0-9])(?:AKIA|ASIA|ghp_|gho_|xox[abp]-|sk_live_|AIza)[A-Za-z0-9_-]{12,}+"
    r"|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
    r"|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}+={0,2}"
)
ASSIGNED = r"^(?i:passwd|password|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?[ ]?[=:][ ]?[\"']?"
KEYWORDS = r"(?i)(passwd|password|pwd|secret|token|api[_ -]?key|access[_ -]?key|credential|auth|bearer|private)"
HARMLESS = r"(?i)(sha-?[0-9]*|md5|checksum|digest|commit|revision|uuid|etag|hash|build|version|id|file|page|order)"
DICTIONARY = (
    r"(?i)(example|changeme|sample|dummy|placeholder|password|secret|token|default|insert|replace|your|here|test|"
    r"todo|null|none|true|false|value|string|hello|world|admin|user|name|key|the|and|for|with|"
    r"tion|ment|keit|lich|heit|schaft|cion|ing|ung|eau|oso|x{4,}|[*]{3,})"
)
TEST_PATH = r"(?i)(test|spec|example|sample|fixture|mock|docs?/|readme)"

FEATURES = ["length", "digits", "uppers", "lowers", "others", "transitions", "longest_letters", "variety", "entropy",
            "hex_only", "covered", "assigned", "known_form", "quoted", "keyword_before", "harmless_before",
            "keyword_after", "harmless_after", "test_path"]


def _share(value: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(value, pattern, "")) / F.greatest(F.length(value), F.lit(1))


def features(findings: DataFrame) -> DataFrame:
    """Adds a number per feature to findings (found, before, after, path)."""
    value = F.regexp_replace(F.col("found"), ASSIGNED, "")
    letters = F.split(value, "")
    entropy = F.aggregate(
        F.array_distinct(letters), F.lit(0.0), lambda sum_, one: sum_ - _part(value, one) * F.log2(_part(value, one))
    )
    assigned = F.col("found").rlike(ASSIGNED) | F.col("before").rlike(r"[=:][ ]?[\"']?$")
    made = {
        "length": F.length(value), "digits": _share(value, "[^0-9]"), "uppers": _share(value, "[^A-Z]"),
        "lowers": _share(value, "[^a-z]"), "others": _share(value, "[A-Za-z0-9]"),
        "transitions": F.regexp_count(
            value, F.lit("(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]|(?<=[a-z])[A-Z]")) / F.greatest(F.length(value), F.lit(1)),
        "longest_letters": F.array_max(F.transform(F.split(value, "[^A-Za-z]+"), lambda run: F.length(run))),
        "variety": F.size(F.array_distinct(letters)) / F.greatest(F.length(value), F.lit(1)), "entropy": entropy,
        "hex_only": value.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "covered": F.lit(1.0) - F.length(F.regexp_replace(value, DICTIONARY, "")) / F.greatest(F.length(value), F.lit(1)),
        "assigned": assigned, "known_form": value.rlike("^(AKIA|ASIA|ghp_|gho_|xox[abp]-|sk_live_|AIza|-----BEGIN)"),
        "quoted": F.col("before").rlike("[\"']$") | F.col("found").rlike("[=:][ ]?[\"']"),
        "keyword_before": F.concat("before", F.col("found").substr(1, 12)).rlike(KEYWORDS),
        "harmless_before": F.col("before").rlike(HARMLESS + r"[\"']?[ ]?[=:]?[ ]?[\"']?$"),
        "keyword_after": F.col("after").rlike(r"^\W{0,3}" + KEYWORDS),
        "harmless_after": F.col("after").rlike(r"^\W{0,3}" + HARMLESS), "test_path": F.col("path").rlike(TEST_PATH),
    }
    return findings.withColumns({name: F.coalesce(column.cast("double"), F.lit(0.0)) for name, column in made.items()})


def _part(value: Column, one: Column) -> Column:
    length = F.length(value)
    return (length - F.length(F.replace(value, one, F.lit("")))) / F.greatest(length, F.lit(1)) / F.greatest(F.length(one), F.lit(1))


def _owner() -> Column:
    """What a row's findings are known by: its doc_id, or the digest of its text where it has none."""
    return F.coalesce(F.col("doc_id").cast("long").cast("string"), F.sha2("text", 256)).alias("owner")


def findings(docs: DataFrame, path: str | None = "source") -> DataFrame:
    """Every candidate: doc_id, number (from 0 in its row), start (characters before it), found, before, after,
    path, owner. Each text is matched as a whole; lengths of the texts between candidates add up to the offsets."""
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path and path in docs.columns else F.lit("")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), where.alias("path"),
        _owner(),
    ).where(F.col("text").rlike(CANDIDATE))
    pattern = F.lit(CANDIDATE)
    cut = rows.select("doc_id", "path", "owner", F.regexp_extract_all("text", pattern, F.lit(0)).alias("found"),
                      F.split("text", CANDIDATE, -1).alias("between"))
    count = F.size("found")

    def further(so_far, i):
        start = so_far["at"] + F.length(F.get("between", i))
        return F.struct(
            (start + F.length(F.get("found", i))).alias("at"), F.array_append(so_far["starts"], start).alias("starts")
        )

    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("starts"))
    starts = F.aggregate(F.sequence(F.lit(0), count - 1), none, further, lambda so_far: so_far["starts"])
    listed = cut.where(count > 0).select(
        "doc_id", "path", "owner", "found", starts.alias("start"),
        F.transform(F.slice("between", F.lit(1), count), lambda s: F.right(s, F.lit(NEAR))).alias("before"),
        F.transform(F.slice("between", F.lit(2), count), lambda s: F.left(s, F.lit(NEAR))).alias("after"),
    )
    one = F.posexplode(F.arrays_zip("found", "start", "before", "after")).alias("number", "one")
    return listed.select("doc_id", "path", "owner", one).select(
        "doc_id", "number", "one.start", "one.found", "one.before", "one.after", "path", "owner"
    )


def labelled_findings(docs: DataFrame, sample: int = SAMPLE, path: str | None = "source") -> DataFrame:
    """Labelled findings derived from at most ``sample`` documents (chosen by a hash of doc_id): digests of a
    document in the places where secrets stand are true findings; digests named as such, before or after them, words,
    placeholders and numbers are false ones. Columns: found, before, after, path, is_secret.

    True findings have the document's own path, those of known forms in a quarter of the documents a path of tests; false ones
    have either. A password or key without a known form is false in a path of tests. Ids are chosen first, so that
    no more texts than the sample's are moved; of rows with one id the least text counts; null texts are empty.
    """
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path and path in docs.columns else F.lit("")
    rows_of = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.struct(F.coalesce("text", F.lit("")).alias("text"), where.alias("own")).alias("one"),
    ).where(F.col("doc_id").isNotNull())
    ids = rows_of.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = rows_of.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("one").alias("one")).select("doc_id", "one.*")
    text, key = F.col("text"), F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.length("text").cast("string"))
    hexed, wide = F.sha1(key), F.base64(F.unhex(F.sha2(key, 256)))
    digits = F.rpad(F.abs(F.xxhash64(key)).cast("string"), 24, "7")
    words = F.regexp_replace(F.lower(text.substr(1, 400)), "[^a-z]+", "")
    around = lambda start: text.substr(F.lit(start), F.lit(NEAR))
    near, after = around(41), around(101)
    plain = F.regexp_replace(near, r"[=:]\s*$", " ")
    said = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    doc = F.col("doc_id").cast("string")
    own, tests = F.col("own"), F.concat(F.lit("tests/fixtures/"), F.col("own"))
    some = F.pmod(F.xxhash64(key), F.lit(4))
    either, mostly_own = F.when(some < 2, own).otherwise(tests), F.when(some > 0, own).otherwise(tests)
    rows = [  # found, before, after, path, whether it is a secret
        (said('token = "', hexed), near, said('"', after), own, 1),
        (said('TOKEN = "', F.upper(hexed)), F.upper(near), said('"', after), own, 1),
        (said("password: ", wide.substr(1, 14)), near, after, own, 1),
        (said("api_key=", wide.substr(1, 32)), near, after, own, 1),
        (said("secret: ", F.md5(key)), near, after, own, 1),
        (said("access-key='", wide.substr(1, 40)), near, said("'", after), own, 1),
        (said("AKIA", F.upper(hexed.substr(1, 16))), near, after, mostly_own, 1),
        (said("ghp_", F.regexp_replace(wide.substr(1, 36), "[+/=]", "q")), near, after, mostly_own, 1),
        (said("ghp_", hexed.substr(1, 36)), near, after, mostly_own, 1),
        (said("sk_live_", hexed.substr(1, 24)), plain, after, mostly_own, 1),
        (wide, said(near, "Authorization: Bearer "), after, mostly_own, 1),
        (hexed, said(near, 'token "'), after, own, 1),
        (hexed, said(plain, '"'), said('" api key', after), own, 1),
        (hexed, said(plain, '"'), said('" checksum', after), either, 0),
        (hexed, said(plain, "("), said(", sha1 of it", after), either, 0),
        (hexed, said(near, "commit "), after, either, 0),
        (F.sha2(key, 256), said(near, "sha256: "), after, either, 0),
        (F.md5(key), said(near, "checksum "), after, either, 0),
        (said("token = ", "your_token_here_", doc), near, after, either, 0),
        (said('password = "', "changeme", doc, "example"), near, said('"', after), either, 0),
        (said("token: ", "xxxxxxxxxxxxxxxxxxxx"), near, after, either, 0),
        (digits, plain, after, either, 0),
        (said(words.substr(1, 24), "1"), plain, after, either, 0),
        (said("item/", words.substr(1, 18), "/", doc, "/page"), plain, after, either, 0),
        (said("secret: ", words.substr(1, 16)), near, after, either, 0),
        (said("password: ", wide.substr(1, 14)), near, after, tests, 0),
        (said("api_key=", wide.substr(1, 32)), near, after, tests, 0),
    ]
    listed = F.array(*[
        F.struct(found.alias("found"), before.alias("before"), next_.alias("after"), place.alias("path"),
                 F.lit(float(label)).alias("is_secret"))
        for found, before, next_, place, label in rows
    ])
    return chosen.select(F.explode(listed).alias("one")).select("one.*")


def train(labelled: DataFrame, trees: int = 30) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (found, before, after, path, is_secret); none without both labels."""
    shaped = kept(_vectors(features(labelled)).select("features", F.col("is_secret").alias("label")), "secret-training")
    if shaped.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(numTrees=trees, maxDepth=7, seed=5).fit(shaped)


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def scan_secrets(docs: DataFrame, labelled: DataFrame, path: str | None = "source", cut: float = CUT) -> DataFrame:
    """Every finding with its score: doc_id, number, start, length, found, score, is_secret.

    Null and empty texts have no findings, nor has an empty table; repeated rows have theirs each; other columns
    are ignored. Without labelled findings of both kinds every candidate is kept as a secret, with score 1.
    """
    return _scored(findings(docs, path), labelled).select(
        "doc_id", "number", "start", F.length("found").alias("length"), "found", "score",
        (F.col("score") >= cut).cast("int").alias("is_secret"),
    )


def _scored(found: DataFrame, labelled: DataFrame) -> DataFrame:
    forest = train(labelled)
    if forest is None:
        return found.withColumn("score", F.lit(1.0))
    return forest.transform(_vectors(features(found))).withColumn("score", vector_to_array("probability")[1])


def redact(docs: DataFrame, labelled: DataFrame, mark: str = "[secret]", cut: float = CUT) -> DataFrame:
    """``docs`` with the secrets of each text replaced by ``mark`` and ``n_chars``, if there, counted anew. Rows
    without secrets stay as they are. Rows without a doc_id are known by their texts."""
    values = _scored(findings(docs), labelled).where(F.col("score") >= cut).groupBy("owner").agg(
        F.sort_array(F.collect_set("found"), asc=False).alias("secrets")
    )
    whole = docs.select(_owner(), F.struct(*docs.columns).alias("whole"))
    joined = whole.join(kept(values, "secrets").hint("shuffle_hash"), "owner", "left")
    text = F.aggregate("secrets", F.col("whole.text"), lambda text, one: F.replace(text, one, F.lit(mark)))
    changed = F.col("whole").withField("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withField("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return joined.select(F.when(F.col("secrets").isNull(), F.col("whole")).otherwise(changed).alias("whole")).select("whole.*")
