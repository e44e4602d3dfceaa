"""Secret scan: pattern candidates, judged by a random forest.

Candidates come first, whatever their length and alphabet: values assigned to a
secret word, passwords in URLs, private-key blocks, dotted web tokens, and long
runs of key characters with a digit.  A text is cut before each of them;
each is described by its length, character classes and transitions,
dictionary coverage, path and neighbouring words.  A random forest, trained
with Spark ML on labelled findings, removes the false positives.  The fitted
trees are turned into one SQL expression, so scoring and redaction are a single
map in built-in functions: nothing is exploded, joined or shuffled to redact.

Defined cases: null text has no candidates and stays null; an empty text stays
empty; a null path counts as empty; a private-key block without an end is
judged run by run; repeated rows are judged alike; extra columns are carried
through; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import let

KEY_CHARS = "A-Za-z0-9+/_\\-"
MIN_LENGTH = 16
CONTEXT = 48        # characters of neighbourhood on each side
TRAIN_ROWS = 8000   # bound of the generated labelled findings
TREES, DEPTH, SEED = 20, 6, 42
THRESHOLD = 0.5
MASK = "[SECRET]"

# Words of identifiers and prose, for dictionary coverage.
DICTIONARY = ("account action admin again array author backup banner before block board build button cache "
              "center change channel check child class client color column common config content control count "
              "create current custom data date default delete design detail device editor error example export "
              "family field figure file filter final first folder footer form group guide handler hash header "
              "hidden history home image import index info input insert item kernel label language layout left "
              "level library light line link list local lock login logo main manager map media member menu "
              "message method model module name native network node note number object office order output "
              "owner page panel param parent parse path pattern print profile project public query record "
              "release remove render report request reset resource response result return root route sample "
              "schema screen script search section select sender server service session setting simple size "
              "sort source space start state static status store stream street string style submit switch "
              "system table target task team temp test text theme thread time title update upload user value "
              "vector version white width window word write year").split()
# Words that announce a secret, and words that announce something else.
SECRET_WORDS = "token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credential"
OTHER_WORDS = ("sha-?1|sha-?256|md5|commit|checksum|digest|hash|uuid|guid|integrity|etag|revision|build|order|card|"
               "phone|isbn|invoice|serial|tracking|id|ref|version|blob|tree")
# Places where a value is assigned to a secret word, or stands as a password in a URL.
ASSIGNED = f"(?i:{SECRET_WORDS})[\"']?(?:\\s{{0,3}}(?:=>|[:=])\\s{{0,3}}[\"']?|(?<=(?i:bearer))\\s)"
IN_URL = "://[^\\s:/@\"']{1,64}:"
VALUE = "[^\\s\"'`,;<>\\[\\](){}]"      # a character of an assigned value
MIN_VALUE = 6
KEY_BLOCK = "-----(?:BEGIN|END) [A-Z ]{0,40}PRIVATE KEY-----"
# one look at the characters before a place rules out nearly all of them, before any word is tried
BEFORE_CANDIDATE = "|".join([
    f"(?<=[:=>\"']|[:=>]\\s|[:=>]\\s\\s|[:=>]\\s\\s\\s|[rR]\\s)(?={VALUE}{{{MIN_VALUE}}})(?<={ASSIGNED})",
    f"(?<=:)(?<={IN_URL})(?=[^\\s@/\"']{{3,128}}@)",
    # a run; not inside an assigned value, nor behind a dot of a web token
    f"(?<![{KEY_CHARS}])(?=[{KEY_CHARS}]{{{MIN_LENGTH},}})(?=[A-Za-z+/_\\-]*[0-9])"
    f"(?<!{ASSIGNED}{VALUE}{{1,128}})(?<!eyJ[{KEY_CHARS}]{{0,256}}\\.)(?<!{IN_URL}[^\\s@/\"']{{1,64}})"])
AROUND_BLOCK = "(?=-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----)|(?<=-----END [A-Z ]{0,40}PRIVATE KEY-----)"
IS_BLOCK = "^-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[\\s\\S]*-----END [A-Z ]{0,40}PRIVATE KEY-----$"
RUN = f"^(?:eyJ[{KEY_CHARS}]+(?:\\.[{KEY_CHARS}]+)+|(?=[A-Za-z+/_\\-]*[0-9])[{KEY_CHARS}]{{{MIN_LENGTH},}}=*)"
# Prefixes that issuers put before their keys.
ISSUED = "^(?:AKIA|ASIA|gh[pousr]_|xox[abpr]-|sk_live_|sk-|rk_live_|AIza|eyJ|glpat-|hf_|npm_|SG)"
PLACEHOLDER = "(?i)example|xxxx|your|change_?me|placeholder|dummy|sample|12345678|abcdef01|00000000"
TEST_PATH = "(?i)(?:^|[/_.\\-])(?:tests?|examples?|fixtures?|samples?|mocks?|docs?|spec)(?:[/_.\\-]|$)"

# Values that refer to a secret kept elsewhere, or stand for none.
REFERENCE = ("^[$%*@&.]|^(?i:none|null|true|false|undefined|required|optional|string|str|os\\.|self\\.|this\\.|env\\.|process\\.|settings\\."
             "|config\\.|args\\.|getenv|getpass|input|request\\.|https?:)|^[a-z_]+(?:\\.[a-z_]+)+$")

FEATURES = ["length", "digits", "upper", "lower", "switches", "case_switches", "distinct", "dictionary", "hex_only",
            "all_digits", "uuid", "separators", "secret_word", "other_word", "assigned", "quoted", "issued",
            "placeholder", "test_path", "symbols", "letters", "in_url", "block", "reference"]


def _n(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _is(text: Column, pattern: str) -> Column:
    return F.rlike(text, F.lit(pattern)).cast("double")


def features(value: Column, left: Column, right: Column, path: Column) -> Column:
    """Struct of the forest's inputs for one candidate and its neighbourhood."""
    n = F.length(value).cast("double")
    covered = n - F.length(F.regexp_replace(F.lower(value), "|".join(sorted(DICTIONARY, key=len, reverse=True)), ""))
    cols = {
        "length": n,
        "digits": _n(value, "[0-9]") / n,
        "upper": _n(value, "[A-Z]") / n,
        "lower": _n(value, "[a-z]") / n,
        "switches": _n(value, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])") / n,
        "case_switches": _n(value, "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])") / n,
        "distinct": F.size(F.array_distinct(F.split(value, ""))).cast("double"),
        "dictionary": covered / n,
        "hex_only": _is(value, "^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "all_digits": _is(value, "^[0-9\\-]+$"),
        "uuid": _is(value, "(?i)^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$"),
        "separators": _n(value, "[_/\\-]") / n,
        "secret_word": _is(left, f"(?i)(?:{SECRET_WORDS})[\"']?\\s*(?:[:=]>?|is|to)?\\s*[\"']?$"),
        "other_word": _is(left, f"(?i)(?:^|[^a-z])(?:{OTHER_WORDS})[\"']?\\s*(?:[:=#]|is|no\\.?)?\\s*[\"']?$"),
        "assigned": _is(left, "[:=]\\s*[\"']?$"),
        "quoted": _is(left, "[\"']$") * _is(right, "^[\"']"),
        "issued": _is(value, ISSUED),
        "placeholder": _is(value, PLACEHOLDER),
        "test_path": _is(path, TEST_PATH),
        "symbols": _n(value, f"[^{KEY_CHARS}=.]"),
        "letters": _is(value, "^[a-z]+[.!?:]?$|^[A-Z]?[a-z\\u00c0-\\u024f]+[.!?:]?$"),
        "in_url": _is(left, IN_URL + "$") * _is(right, "^@"),
        "block": _is(value, "^-----BEGIN "),
        "reference": _is(value, REFERENCE),
    }
    return F.struct(*[cols[k].alias(k) for k in FEATURES])


def labelled_findings(spark: SparkSession, rows: int = TRAIN_ROWS) -> DataFrame:
    """(value, left, right, path, label): findings of known kind, at most ``rows`` of them.

    Key-like values come from hashes of the row number.  The first kinds are
    secrets in the ways they are usually written; the others look alike but
    are not: digests, ids, numbers, identifiers, paths, placeholders."""
    i = F.col("id")
    h = F.sha2(F.concat(F.lit("finding"), i.cast("string")), 512)
    b64 = F.translate(F.base64(F.unhex(h)), "=", "")
    u = F.pmod(F.xxhash64("id"), F.lit(1000))
    hexed = F.when(u % 5 == 0, F.upper(h)).otherwise(h)

    def one(*values: str) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(len(values))) + 1).cast("int"))

    word = [F.element_at(F.array(*[F.lit(w) for w in DICTIONARY]),
                         (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(DICTIONARY))) + 1).cast("int")) for k in range(5)]
    secret_left = one('token = "', 'secret: ', 'password=', 'api_key = "', 'API_KEY="', "auth_token: '", 'TOKEN = "',
                      'Authorization: Bearer ', 'access_key = "', 'my secret is ', "the password is ", 'client_secret="')
    plain_left = one("", "see ", "the ", "in ", "and ", "| ", "from ", "with ", "on ", ". ")
    other_left = one("commit ", "sha256: ", 'md5 = "', "checksum: ", "uuid=", 'id: "', "order no. ", "build ", "etag: ",
                     "sha1:", "tracking ", "invoice ")
    n40, n32 = F.substring(hexed, 1, 40), F.substring(hexed, 41, 32)
    plain64 = F.translate(b64, "+/", "")
    digits = F.substring(F.translate(h, "abcdef", ""), 2, 2)
    assigned_left = one('password = "', "password: ", "PASSWORD=", 'token = "', "secret=", "api_key: ", 'secret = "', "pwd=", "passwd: '")
    url_left = one("postgres://app:", "https://user:", "mysql://root:", "amqp://svc:", "redis://cache:")
    block = one("-----BEGIN PRIVATE KEY-----", "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN EC PRIVATE KEY-----")
    kinds = [  # value, left, label
        (n40, secret_left, 1), (F.substring(b64, 1, 40), secret_left, 1), (n32, secret_left, 1),
        (F.concat(F.lit("AKIA"), F.upper(F.substring(b64, 5, 16))), one("", "key ", 'id = "', "use "), 1),
        (F.concat(F.lit("ghp_"), F.translate(F.substring(b64, 1, 38), "+/", "")), one("", "use ", 'token = "'), 1),
        (F.concat(F.lit("sk_live_"), F.translate(F.substring(b64, 9, 26), "+/", "")), one("", "key: ", "with "), 1),
        (F.substring(b64, 1, 24), secret_left, 1),
        (n40, other_left, 0), (F.substring(h, 1, 64), other_left, 0), (n32, plain_left, 0),
        (n40, plain_left, 0),
        (F.translate(F.substring(h, 1, 16), "abcdef", "123456"), plain_left, 0),
        (F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4),
                     F.substring(h, 21, 12)), one("", "id: ", "uuid = \"", "request "), 0),
        (F.concat_ws("_", *word[:3], u.cast("string")), one("", 'id = "', "name: ", "call ", 'token = "'), 0),
        (F.concat_ws("/", *word[:4], u.cast("string")), plain_left, 0),
        (F.concat(F.initcap(word[0]), F.initcap(word[1]), F.initcap(word[2]), u.cast("string")), plain_left, 0),
        (F.concat_ws("-", word[0], word[1], word[2], word[3], u.cast("string")), plain_left, 0),
        (F.concat(one("your_api_key_", "xxxxxxxxxxxxxxxx", "EXAMPLE_KEY_", "changeme_", "1234567890abcdef0",
                      "00000000000000000"), u.cast("string"), F.lit("000000")), secret_left, 0),
        (F.concat(word[0], word[1], word[2], word[3], u.cast("string")), plain_left, 0),
        (F.translate(F.substring(h, 9, 19), "abcdef", "709215"), one("card ", "phone: ", "isbn ", "", "order "), 0),
        # short and mixed values, assigned
        (F.substring(plain64, 1, 10), assigned_left, 1), (F.substring(h, 3, 12), assigned_left, 1),
        (F.translate(F.substring(plain64, 1, 30), "0123456789", ""), assigned_left, 1),
        (F.concat(word[0], digits, one("!", "$", "#", "%", "&"), F.substring(plain64, 4, 2)), assigned_left, 1),
        (F.concat(F.substring(plain64, 1, 9), one("&", "!", "@", "^", "*"), digits, one("!", "?", "-", "."), word[1]), assigned_left, 1),
        (F.concat(one("sk-proj-", "pk.", "key-", "v1."), F.substring(plain64, 3, 11), F.lit("."), F.substring(plain64, 20, 10)), assigned_left, 1),
        (F.concat(F.lit("eyJ"), F.substring(plain64, 1, 17), F.lit(".eyJ"), F.substring(plain64, 9, 30), F.lit("."), F.substring(plain64, 5, 40)),
         one("", "jwt ", "Authorization: Bearer ", 'token = "'), 1),
        (F.concat(F.substring(plain64, 2, 4), one("cr3t", "P", "$", "", "!"), F.substring(plain64, 30, 3)), url_left, 1),
        (F.concat(word[2], digits), url_left, 1),
        (F.concat(block, F.lit("\\n"), b64, F.lit("\\n"), F.reverse(b64), F.lit("\\n"), F.replace(block, F.lit("BEGIN"), F.lit("END"))), plain_left, 1),
        # ... and what stands there without being one
        (word[0], assigned_left, 0), (F.concat(F.initcap(word[3]), one("", ".", "!", ":")), assigned_left, 0),
        (F.concat(F.translate(F.substring(h, 1, 9), "0123456789", "aeioulnrst"), one("", ".", "?")), assigned_left, 0),
        (F.concat_ws("_", word[0], word[1]), assigned_left, 0), (F.concat_ws(".", one("os", "self", "config", "settings", "args"), word[1]), assigned_left, 0),
        (F.concat(one("$", "${", "%", "****", "xxxx"), F.upper(word[1])), assigned_left, 0),
        (one("required", "optional", "None", "undefined", "string", "********", "changeme", "your_password", "example"), assigned_left, 0),
        (F.concat_ws("-", word[0], word[1], word[2]), assigned_left, 0),
    ]
    kind = F.pmod(i, F.lit(len(kinds)))

    def pick(k: int) -> Column:
        return reduce(lambda tail, at: F.when(kind == at, kinds[at][k] if isinstance(kinds[at][k], Column)
                                              else F.lit(kinds[at][k])).otherwise(tail),
                      range(len(kinds)), F.lit(None))

    prose = F.concat_ws(" ", *word)
    out = spark.range(0, rows, 1, 1).select(
        "id", pick(0).alias("value"), F.concat(prose, F.lit(" "), pick(1)).alias("left"), pick(2).alias("label"),
        F.concat_ws("/", word[4], one("src/main.py", "conf/app.yaml", "notes.txt", "README", "tests/test_a.py"))
        .alias("path"))
    # a value opened by a quotation mark is closed by it; about one in ten of the others ends a quotation
    closing = F.when(F.rlike("left", F.lit("\"$")), F.lit('"')).when(F.rlike("left", F.lit("'$")), F.lit("'")) \
        .when(F.rlike("left", F.lit(IN_URL + "$")), F.lit("@db.host/")).otherwise(F.lit(""))
    return out.select("value", "left", F.concat(closing, F.lit(" "), prose).alias("right"), "path",
                      F.col("label").cast("double").alias("label"))


def train(findings: DataFrame) -> RandomForestClassificationModel:
    """Forest over labelled findings (value, left, right, path, label)."""
    described = findings.select("label", features(F.col("value"), F.col("left"), F.col("right"), F.col("path"))
                                .alias("f")).select("label", "f.*")
    # the fit reads its rows several times; one partition, as bagging follows the partitions
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(materialize(described, "findings").coalesce(1))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxBins=64).fit(table.select("features", "label"))


_FITTED: dict[str, RandomForestClassificationModel] = {}


def usual_model(spark: SparkSession) -> RandomForestClassificationModel:
    """The forest of the generated findings, fitted once in an application."""
    app = spark.sparkContext.applicationId
    if app not in _FITTED:
        _FITTED[app] = train(labelled_findings(spark))
    return _FITTED[app]


def forest_score(model: RandomForestClassificationModel, f: Column) -> Column:
    """The forest's probability of a secret as an expression over the feature struct."""
    def walk(node) -> Column:
        if node.getClass().getSimpleName() == "LeafNode":
            stats = list(node.impurityStats().stats())
            return F.lit(float(stats[1] / sum(stats)))
        split = node.split()
        name = FEATURES[split.featureIndex()]
        return F.when(f[name] <= F.lit(float(split.threshold())), walk(node.leftChild())) \
            .otherwise(walk(node.rightChild()))

    trees = [walk(t._call_java("rootNode")) for t in model.trees]
    return reduce(lambda a, b: a + b, trees) / F.lit(float(len(trees)))


def scored_parts(text: Column, path: Column, model: RandomForestClassificationModel) -> Column:
    """The text cut before each candidate: array of (value, rest, score); a part
    without a candidate has a null value.  Joining value and rest gives the text."""
    def judged(parts: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            left = F.coalesce(F.substring(F.get(parts, i - 1), -CONTEXT, CONTEXT), F.lit(""))
            run = F.regexp_extract(x, RUN, 0)
            assigned = F.regexp_extract(x, f"^{VALUE}{{{MIN_VALUE},}}", 0)
            value = F.when(F.rlike(x, F.lit(IS_BLOCK)), x) \
                .when(F.rlike(left, F.lit(IN_URL + "$")) & F.rlike(x, F.lit("^[^\\s@/\"']{3,128}@")), F.regexp_extract(x, "^[^\\s@/\"']{3,128}", 0)) \
                .when(F.rlike(left, F.lit(f"(?:{ASSIGNED})$")) & (assigned != ""), assigned).otherwise(run)

            def with_value(v: Column) -> Column:
                rest = F.substring(x, F.length(v) + 1, F.length(x))
                described = features(v, left, F.substring(rest, 1, CONTEXT), F.coalesce(path, F.lit("")))
                score = F.when(v != "", let(described, lambda f: forest_score(model, f)))
                return F.struct(F.when(v != "", v).alias("value"), rest.alias("rest"), score.alias("score"))
            return let(value, with_value)
        return F.transform(parts, one)
    # key blocks stay whole; all other text is cut before its candidates
    def cut(pieces: Column) -> Column:
        return F.flatten(F.transform(pieces, lambda p: F.when(F.rlike(p, F.lit(IS_BLOCK)), F.array(p)).otherwise(F.split(p, BEFORE_CANDIDATE))))

    parts = F.when(F.contains(text, F.lit("PRIVATE KEY-----")), let(F.split(text, AROUND_BLOCK), cut)).otherwise(F.split(text, BEFORE_CANDIDATE))
    return let(parts, judged)


def findings(docs: DataFrame, model: RandomForestClassificationModel, id_col: str = "doc_id", text: str = "text",
             path: str | None = "source", threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, start, length, value_sha256, score, is_secret), a row per candidate;
    ``start`` counts characters from 0.  Candidates never leave in clear text."""
    where = F.col(f"`{path}`") if path else F.lit("")
    # an array of (start, ...) per row, by a running sum over the row's parts
    kind = "array<struct<start:bigint,value:string,score:double>>"
    first = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(kind).alias("out"))
    parts = scored_parts(F.col(f"`{text}`"), where, model)
    placed = F.aggregate(
        parts, first,
        lambda a, x: F.struct(
            (a["at"] + F.length(F.coalesce(x["value"], F.lit(""))) + F.length(x["rest"])).alias("at"),
            F.when(x["value"].isNull(), a["out"]).otherwise(F.concat(a["out"], F.array(F.struct(
                a["at"].alias("start"), x["value"].alias("value"), x["score"].alias("score"))))).alias("out")),
        lambda a: a["out"])
    return docs.select(F.col(f"`{id_col}`").alias(id_col), F.explode(placed).alias("f")) \
        .select(id_col, "f.start", F.length("f.value").cast("bigint").alias("length"),
                F.sha2("f.value", 256).alias("value_sha256"), F.round("f.score", 6).alias("score"),
                (F.col("f.score") >= threshold).alias("is_secret"))


def redact(docs: DataFrame, model: RandomForestClassificationModel, text: str = "text", path: str | None = "source",
           threshold: float = THRESHOLD, mask: str = MASK) -> DataFrame:
    """``docs`` with every secret of the text replaced by ``mask``; other columns and rows as they are."""
    where = F.col(f"`{path}`") if path else F.lit("")
    parts = scored_parts(F.col(f"`{text}`"), where, model)
    clean = F.array_join(F.transform(parts, lambda x: F.concat(
        F.when(x["score"] >= threshold, F.lit(mask)).otherwise(F.coalesce(x["value"], F.lit(""))), x["rest"])), "")
    return docs.withColumn(text, F.when(F.col(f"`{text}`").isNotNull(), clean))
