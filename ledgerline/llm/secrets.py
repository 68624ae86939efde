"""Secret scan with a random forest that removes false positives, in DataFrame
functions only.

Candidates are long runs of key characters with a digit, private-key blocks, JWTs,
and every value that is assigned to a secret's name.
A forest, trained from labelled findings, scores each from its length, character
classes and transitions, dictionary coverage, path, and neighbouring words.  The
trees are turned into column expressions, so scoring stays in the JVM and the
scan needs no shuffle; texts are split at their candidates in place.

Defined results: a null or empty text has no finding and stays as it is; repeated
rows get their findings each; a null path counts as no path; other columns pass
through, one named like the result column gives way; an empty table gives an
empty result.  If the labelled findings are empty or all alike, every candidate
gets their share of positives (1 if there are none).
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import cut

JWT = r"eyJ[A-Za-z0-9_\-]{5,}+\.[A-Za-z0-9_\-]{5,}+(?:\.[A-Za-z0-9_\-]*+)?"
_KEY_EDGE = r"[A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)? ?-{4,5}"
#: from BEGIN to END with any body; a block without its end as far as it looks like one
KEY_BLOCK = (
    rf"-{{4,5}} ?BEGIN {_KEY_EDGE}(?:[^\-]*+(?:-(?!-{{3,4}} ?(?:BEGIN|END) )[^\-]*+)*+-{{4,5}} ?END {_KEY_EDGE}"
    r"|(?:[A-Za-z0-9+/=\s]|\\[nrt]|(?:: |,)[^\r\n\\]{1,200}+(?=[\r\n\\]))*+)"
)
_SECRET_NAME = r"(?i:key|token|secret|passw|passphrase|pwd|auth|credential|bearer|private)"
_SCHEME = r"(?:(?:Bearer|Basic)\s)?"
_ASSIGNED = _SECRET_NAME + r"[A-Za-z0-9_\-]{0,20}\\?[\"']?\s{0,4}(?::=|=>|=|:)\s{0,4}" + _SCHEME
#: what each of the longer lookbehinds below ends in; it is short, so it is tried before them
_SIGN = rf"(?<=[=:>]\s{{0,4}}{_SCHEME}\\?[\"']?)"
#: what is assigned to a secret's name: up to its quote, or to white space without the punctuation before it
NAMED_VALUE = (
    rf"(?<=[=:>\s\"'])(?![\s\"'=:>]){_SIGN}(?:(?<={_ASSIGNED}\\?\")(?:[^\"\\\r\n]|\\.)++(?=\")|(?<={_ASSIGNED}\\?')(?:[^'\\\r\n]|\\.)++(?=')"
    rf"|(?<={_ASSIGNED}\\?[\"']?)(?!(?:Bearer|Basic)\s)"
    r"(?:[^\s\"`,;.!?)\]}'\\&<]++|[,;.!?)\]}'\\](?![,;.!?)\]}'\\]*+(?:[\s\"`]|$|</))|&(?![\w.\-]{1,40}=)|<(?!/))++)"
)
#: a private-key block, a JWT, a named value, or 16 and more key characters in a row
CANDIDATE = KEY_BLOCK + "|" + JWT + "|" + NAMED_VALUE + r"|[A-Za-z0-9+/_\-]{16,}={0,2}"
CONTEXT = 64
MASK = "[SECRET]"
#: findings at most that the forest is trained on
TRAINING_ROWS = 4000
TREES, DEPTH = 12, 5

# fixed values: words of sample values and code that random keys do not hold
DICTIONARY = (
    "example sample test dummy fake mock placeholder changeme change your here insert replace todo none null true false "
    "default value string user name admin root demo local host http https www com org net html index page file path image "
    "data key token secret password api access auth client server service config version license public abcdef 123456 xxxx"
).split()
_DICTIONARY = "(" + "|".join(sorted(DICTIONARY, key=len, reverse=True)) + ")"
_NAMED = r"(?i)(key|token|secret|passw|pwd|auth|credential|bearer|private)[a-z_\-]{0,20}[\"']?\s{0,4}(:=|=>|=|:|\s)\s{0,4}[\"']?$"
_HASHED = r"(?i)(sha|md5|hash|digest|checksum|commit|revision|rev|uuid|guid|integrity|etag|blob|tree)[a-z0-9_\-]{0,12}[\"']?\s{0,4}(:=|=>|=|:|\s|\()\s{0,4}[\"']?$"
# fixed values: prefixes by which providers mark their keys
_PROVIDER = (
    r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}$|gh[pousr]_[A-Za-z0-9]{30,}|github_pat_[A-Za-z0-9_]{20,}|glpat-[A-Za-z0-9_\-]{20,}|xox[abeprs]-[A-Za-z0-9\-]{10,}"
    r"|[sr]k_live_[A-Za-z0-9]{16,}|sk-[A-Za-z0-9_\-]{20,}|AIza[A-Za-z0-9_\-]{30,}|npm_[A-Za-z0-9]{30,}|pypi-[A-Za-z0-9_\-]{30,})"
)
_BLOCK = "^-{4,5} ?BEGIN "
_STRUCTURAL = rf"{_BLOCK}|^{JWT}$|{_PROVIDER}"
_SAMPLE = "example|sample|placeholder|changeme|dummy"
_SAMPLE_PATH = r"(?i)(test|example|sample|spec|mock|fixture|doc|demo)"


def features(value: Column, before: Column, after: Column, path: Column) -> list[Column]:
    """The forest's features of a candidate, each a double."""
    n = F.greatest(F.length(value), F.lit(1))
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / n
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    lower = F.lower(value)
    columns = [
        n,
        share("[0-9]"),
        share("[A-Z]"),
        share(r"[+/_\-=]"),
        share("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"),
        share("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        share("(?i)(?<=[aeiouy])(?=[bcdfghjklmnpqrstvwxz])"),
        F.size(F.array_distinct(F.split(value, ""))) / n,
        1 - F.length(F.regexp_replace(lower, _DICTIONARY, "")) / n,
        flag(value.rlike("^[0-9a-f]+$")),
        flag(value.rlike(_BLOCK)),
        share(r"[^A-Za-z0-9+/_\-=]"),
        flag(value.rlike(_PROVIDER)),
        flag(value.rlike(_STRUCTURAL)),
        flag(lower.rlike(_SAMPLE)),
        flag(before.rlike(_NAMED)),
        flag(before.rlike(_HASHED)),
        flag(before.rlike(r"[=:]\s{0,4}[\"']?$")),
        flag(after.rlike("^[\"']")),
        flag(path.rlike(_SAMPLE_PATH)),
    ]
    return [c.cast("double") for c in columns]


def split_candidates(docs: DataFrame, text: str, path: str | None, prefix: str) -> DataFrame:
    """Add four columns whose names start with ``prefix``: the ``pieces`` between
    candidates, the candidates' ``values``, the ``path``, and the candidates ``found``
    with their context.  Each is a column of its own, so that the text is searched
    once and not for every use of a struct that holds them."""
    # a candidate holds a digit, is a key block or has a secret's name
    may = F.col(text).rlike(f"[0-9]|PRIVATE KEY|{_SECRET_NAME}")
    col = lambda f: F.col(f"{prefix}{f}")
    raw = docs.select(
        "*",
        F.when(may, F.split(F.col(text), CANDIDATE, -1)).alias(f"{prefix}pieces"),
        F.when(may, F.regexp_extract_all(F.col(text), F.lit(CANDIDATE), F.lit(0))).alias(f"{prefix}values"),
        (F.col(path).cast("string") if path else F.lit(None).cast("string")).alias(f"{prefix}path"),
    )
    # the context goes on into the candidate before, which may be a long name
    before = lambda i: F.right(F.concat(F.when(i > 0, F.get(col("values"), i - 1)).otherwise(""), F.element_at(col("pieces"), i + 1)), F.lit(CONTEXT))
    found = F.transform(col("values"), lambda v, i: F.struct(v.alias("value"), before(i).alias("before"), F.left(F.element_at(col("pieces"), i + 2), F.lit(CONTEXT)).alias("after")))
    named = _ASSIGNED + r"\\?[\"']?$"
    found = F.transform(
        found,
        lambda x: F.struct(
            x["value"].alias("value"),
            ((x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]")) | x["value"].rlike(_STRUCTURAL) | x["before"].rlike(named)).alias("plausible"),
            x["before"].alias("before"),
            x["after"].alias("after"),
        ),
    )
    return raw.withColumn(f"{prefix}found", found)


def _prefix(docs: DataFrame) -> str:
    """A start of column names that no column of ``docs`` has."""
    prefix = "secret_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    return prefix


def plausible(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """One row per plausible candidate: ``value, before, after, path``."""
    c = _prefix(docs)
    found = split_candidates(docs, text, path, c).select(F.col(f"{c}path").alias("path"), F.explode(f"{c}found").alias("x"))
    return found.where("x.plausible").select("x.value", "x.before", "x.after", "path")


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per plausible candidate: key, start and length in characters, and
    ``value, before, after, path``."""
    plain = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), *([F.col(path).alias("path")] if path else []))
    split = split_candidates(plain, "text", "path" if path else None, "secret_").where(F.exists("secret_found", lambda x: x["plausible"]))
    listed = split.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("secret_path").alias("path"), F.col("secret_pieces").alias("pieces"), F.col("secret_found").alias("found"))
    gaps = F.arrays_zip(F.transform("pieces", lambda p: F.length(p)).alias("gap"), F.col("found").alias("found"))
    each = listed.select("row", "doc_id", "path", F.posexplode(gaps).alias("i", "x"))
    # offsets by a running sum over one text's candidates
    size = F.coalesce(F.length("x.found.value"), F.lit(0))
    here = F.sum(F.col("x.gap") + size).over(Window.partitionBy("row").orderBy("i")) - size
    return each.withColumn("start", here).where("x.found.plausible").select(
        "doc_id", "start", F.length("x.found.value").cast("bigint").alias("length"), "x.found.value", "x.found.before", "x.found.after", "path"
    )


def _truth() -> Column:
    """Weak label: structural findings, and values assigned to a secret's name, that
    are not sample values."""
    structural = F.col("value").rlike(_STRUCTURAL)
    kinds = sum((F.col("value").rlike(k).cast("int") for k in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]")), F.lit(0))
    # a word, a reference, a call or a phrase is no key
    keylike = (F.length("value") >= 6) & (kinds >= 2) & ~F.col("value").rlike(r"^[A-Z]?[a-z]+\W?$|^[$<{(%*\[/]|[A-Za-z]\(|\s|environ|config\.")
    password = F.col("before").rlike(r"(?i)(passw(or)?d|passphrase|pwd)[\"']?\s{0,4}[:=]+\s{0,4}[\"']$") & ~F.col("value").rlike(r"^[$<{(%*]|^\s*$|(?i)^(null|none|true|false|string|password)$")
    named = F.col("before").rlike(_NAMED) & ~F.col("before").rlike(_HASHED) & (keylike | password)
    sample = F.lower("value").rlike(_SAMPLE) & ~structural
    return F.coalesce((structural | named) & ~sample, F.lit(False)).cast("double")


def _pick(values: list, by: Column) -> Column:
    return F.element_at(F.array(*(v if isinstance(v, Column) else F.lit(v) for v in values)), F.pmod(by, F.lit(len(values))).cast("int") + 1)


def _bare(taken: DataFrame) -> DataFrame:
    """Invented structural findings in prose, one for each taken candidate."""
    digest = F.sha2(F.concat("value", "before"), 256)
    b = F.regexp_replace(F.base64(F.unhex(digest)), "[^A-Za-z0-9]", "")
    block = lambda kind: F.concat(F.lit(f"-----BEGIN {kind}-----\n"), b, F.lit("\n"), b, b, F.lit(f"\n-----END {kind}-----"))
    kinds = [
        F.concat(F.lit("AKIA"), F.upper(F.left(b, F.lit(16)))), F.concat(F.lit("ghp_"), F.left(b, F.lit(36))), F.concat(F.lit("sk_live_"), F.left(b, F.lit(24))),
        F.concat(F.lit("eyJ"), F.left(b, F.lit(20)), F.lit(".eyJ"), b, F.lit("."), b), block("RSA PRIVATE KEY"), block("PRIVATE KEY"),
    ]
    places = ["", " ", "we found ", "\n", ", then ", "("]
    by = F.crc32("value")
    return taken.select(_pick(kinds, by).alias("value"), _pick(places, F.floor(by / 7)).alias("before"), _pick(["", " and more", "\n", ".", ")"], F.floor(by / 11)).alias("after"), "path", F.lit(1.0).alias("label"))


def weak_labels(findings: DataFrame, limit: int = TRAINING_ROWS) -> DataFrame:
    """Labelled findings from candidates without labels: structural findings (key
    blocks, providers' prefixes, JWTs) and values that are assigned to a secret's name
    are secrets; the same values under a hash's name, and sample values under a
    secret's name, are not.  Invented structural findings without a name are added, as
    a table may hold few.  At most ``limit`` rows; distinct candidates are taken by
    hash, half of them positives and half negatives as far as there are so many."""
    least = F.min(F.struct("after", "path")).alias("x")
    distinct = cut(findings.groupBy("value", "before").agg(least).select("value", "before", "x.after", "x.path", _truth().alias("label")))
    half = lambda label: distinct.where(F.col("label") == label).orderBy(F.xxhash64("value", "before"), "value", "before").limit(limit // 8)
    taken = plain = cut(half(1.0).unionByName(half(0.0)))
    under_hash = taken.where(~F.col("value").rlike(_STRUCTURAL)).select(
        "value",
        F.concat(F.left("before", F.lit(20)), F.element_at(F.array(*map(F.lit, (" sha256: ", ' commit = "', " checksum ", "md5="))), F.pmod(F.crc32("value"), F.lit(4)).cast("int") + 1)).alias("before"),
        "after", "path", F.lit(0.0).alias("label"),
    )
    word = F.element_at(F.array(*map(F.lit, ("your-api-key-here-", "example_token_", "changeme-please-", "test-secret-value-", "xxxxxxxxxxxxxxxx"))), F.pmod(F.crc32("value"), F.lit(5)).cast("int") + 1)
    sample = taken.select(F.concat(word, F.lit("123")).alias("value"), F.lit('api_key = "').alias("before"), F.lit('"').alias("after"), "path", F.lit(0.0).alias("label"))
    return plain.unionByName(under_hash).unionByName(sample).unionByName(_bare(taken))


def _leaf_share(stats) -> float:
    total = float(sum(stats))
    return float(stats[1]) / total if len(stats) > 1 and total else 0.0


def _tree(node):
    """A fitted tree as nested tuples (feature, threshold, left, right), leaves as shares."""
    if node.subtreeDepth() == 0:
        return _leaf_share(list(node.impurityStats().stats()))
    split = node.split()
    return split.featureIndex(), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def fit_forest(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH) -> list:
    """Train on ``labelled(value, before, after, path, label)``; the trees as plain values."""
    f = F.array(*features(F.col("value"), F.col("before"), F.col("after"), F.col("path")))
    data = cut(labelled.select(f.alias("f"), "label").where("label is not null and forall(f, x -> x is not null)"))
    n, share = data.agg(F.count("*"), F.avg("label")).first()
    if not n or share in (0.0, 1.0):
        return [1.0 if not n else float(share)]
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=7, featuresCol="v", labelCol="label", featureSubsetStrategy="0.5", subsamplingRate=0.8
    ).fit(data.select(array_to_vector("f").alias("v"), "label"))
    return [_tree(t._java_obj.rootNode()) if hasattr(t, "_java_obj") else t for t in forest.trees]


def score(forest: list, f: Column) -> Column:
    """Mean leaf share of the trees as a column expression over the feature array."""

    def walk(node) -> Column:
        if not isinstance(node, tuple):
            return F.lit(float(node))
        k, threshold, left, right = node
        return F.when(F.element_at(f, k + 1) <= threshold, walk(left)).otherwise(walk(right))

    total = walk(forest[0])
    for tree in forest[1:]:
        total = total + walk(tree)
    return total / len(forest)


def judge(found: DataFrame, forest: list, threshold: float = 0.5) -> DataFrame:
    """``candidates`` with the forest's ``score`` and the verdict ``is_secret``."""
    f = F.array(*features(F.col("value"), F.col("before"), F.col("after"), F.col("path")))
    described = found.select("*", f.alias("f")).withColumn("score", score(forest, F.col("f")))
    return described.select(*found.columns, F.round("score", 6).alias("score"), (F.col("score") >= threshold).alias("is_secret"))


def findings(docs: DataFrame, forest: list, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per plausible candidate: key, start and length in characters, the value,
    its score and verdict."""
    return judge(candidates(docs, key, text, path), forest).drop("before", "after", "path")


def scan(docs: DataFrame, forest: list, text: str, path: str | None, prefix: str, threshold: float = 0.5) -> DataFrame:
    """``split_candidates`` and a column ``judged``, prefixed too: the candidates with
    their verdict."""
    split = split_candidates(docs, text, path, prefix)
    where = F.col(f"{prefix}path")
    described = F.transform(
        f"{prefix}found",
        lambda x: F.struct(x["value"].alias("value"), F.when(x["plausible"], F.array(*features(x["value"], x["before"], x["after"], where))).alias("f")),
    )
    verdict = lambda x: F.when(x["f"].isNotNull(), score(forest, x["f"]) >= threshold).otherwise(False)
    return split.withColumn(f"{prefix}judged", F.transform(described, lambda x: F.struct(x["value"].alias("value"), verdict(x).alias("is_secret"))))


def redact(docs: DataFrame, forest: list, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with every secret in the text replaced by ``MASK``."""
    c = _prefix(docs)
    scanned = scan(docs, forest, text, path, c)
    shown = F.transform(f"{c}judged", lambda x: F.when(x["is_secret"], F.lit(MASK)).otherwise(x["value"]))
    joined = F.array_join(F.zip_with(f"{c}pieces", shown, lambda p, v: F.concat(p, F.coalesce(v, F.lit("")))), "")
    hit = F.coalesce(F.exists(f"{c}judged", lambda x: x["is_secret"]), F.lit(False))
    return scanned.select(*(F.when(hit, joined).otherwise(F.col(text)).alias(n) if n == text else F.col(n) for n in docs.columns))
