"""Secret scans: candidate strings judged by a random forest.

Candidates come from three searches of the whole text: values assigned to a
secret-like name, formats of known issuers, and long strings that mix letters
and digits.  A forest trained from labelled findings then removes the false
positives by the candidate's length, its character transitions, how much of it
dictionary words cover, the document's path, and the words around it.

Training sees at most ``TRAIN_FINDINGS`` labelled findings on the driver; the
labelled set here is written by rule (``labelled_findings``), and ``fit`` takes
any other.  The scan is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import documents, ship

TRAIN_FINDINGS = 4000
#: Share of trees that must call a finding a secret.
THRESHOLD = 0.5
_NAME = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?key|auth[_-]?key|credential)s?")
_VALUE = re.compile(r"""[\w.\-\]]{0,32}["']?[ \t]{0,4}(?::=|=>|=|:)[ \t]{0,4}(?:bearer[ \t]{1,4})?["'`]?([^\s"'`,;<>(){}\[\]]{8})""", re.I)
_RUN = re.compile(r"""[^\s"'`,;<>(){}\[\]]*""")
_KNOWN = (
    ("aws-key-id", re.compile(r"\bAKIA[0-9A-Z]{16}\b")),
    ("github", re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}")),
    ("slack", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}")),
    ("stripe", re.compile(r"\b[sr]k_live_[0-9A-Za-z]{20,}")),
    ("google", re.compile(r"\bAIza[0-9A-Za-z_\-]{35}")),
    ("jwt", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
)
_EDGE = re.compile(r"-----(BEGIN|END) [A-Z ]{0,20}PRIVATE KEY(?: BLOCK)?-----")
_BASE64 = re.compile(r"[A-Za-z0-9+/]{16,}={0,2}")
# Lines of a block without an end: blanks, quotes and headers, then base64; a last line may be short.
_HEAD = re.compile(r"""(?:\s|\\[nrt]|["'`+,>#*|]|(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset)\s{0,4}:(?:(?!\\[nr])[^\n])*)*""")
_LINE = re.compile(r"""(?:\s|\\[nrt]|["'`+,>#*|])*([A-Za-z0-9+/]{16,}={0,2})""")
_LAST = re.compile(r"""["'`+, \t]{0,8}(?:\r?\n|\\r\\n|\\n)[ \t>#*|"'`]{0,40}[A-Za-z0-9+/]{1,15}={0,2}(?=["'`]|\s*$|[ \t]*\r?\n|\\[nr])""")
_MIXED = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}")
_NEAR_SECRET = re.compile(r"(?i)token|secret|passw|pwd|api.?key|access.?key|private.?key|credential|auth|bearer|login")
_NEAR_HARMLESS = re.compile(r"(?i)example|sample|dummy|placeholder|fake|commit|hash|sha-?\d*|md5|checksum|digest|integrity|uuid|guid|build|revision|href|src|img|image|file|path|trace")
_PLACEHOLDER = re.compile(r"(?i)your|xxx|example|change.?me|placeholder|dummy|sample|redacted|\*\*\*|\.\.\.|\$\{|\{\{|process\.env|os\.environ|getenv|todo|insert|foobar|12345|abcdef|qwerty|undefined|null|none")
_PATH_HARMLESS = re.compile(r"(?i)test|spec|example|sample|doc|fixture|mock|lock|vendor|\.min\.")
#: Words whose presence inside a candidate speaks for an identifier.
DICTIONARY = (
    "access account action active admin alpha android application array async attribute audio auth author backend background base binary block board book bool border bottom branch browser buffer build "
    "builder button cache call cancel center change channel character check child class clean client clone close cloud cluster code collection color column command comment commit common complete component "
    "config connect connection console constant container content context control controller convert cookie copy core count counter create credential current custom data database date debug default "
    "delete device dialog digest directory disable display document domain download driver dummy element email enable encode engine entity entry error event example exception execute export "
    "factory false field file filter final find first folder font format frame function generate get global graph group handler hash header height hello helper hidden home host image import index "
    "info initialize input insert install instance integer interface internal item java json kernel keyboard label language last layer layout left length level library light line link list listener "
    "load local lock login logger machine manager map master match memory menu message meta method mobile mode model module mouse name native network node normal notification number object offset "
    "open option order output owner package page panel parameter parent parse password path pattern performance permission picker place plugin point policy pool position private process processor "
    "profile project property protocol provider public query queue random range read record refresh region register release remote remove render replace report request reset resource response "
    "result return right root route router sample scale schedule schema scope screen script scroll search secret section select server service session setting shadow share simple size socket "
    "source space start state static status storage store stream string style submit success support sync system table target task template test text theme thread time title toggle token tool top "
    "total track transaction transform translate tree true type update upload user utility valid value variable vector version video view visible warning widget width window with word wrapper write your"
).split()
_WORDS = re.compile("|".join(sorted({w for w in DICTIONARY if len(w) >= 4}, key=len, reverse=True)), re.I)
FEATURES = ("length", "digits", "lower", "upper", "other", "transitions", "entropy", "vowels", "longest_run", "dictionary", "placeholder", "hex", "slashes", "dots", "assigned", "near_secret", "near_harmless", "quoted", "path_harmless", "known", "uuid")
_UUID = re.compile(r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")


def private_keys(text: str) -> list[tuple[int, int]]:
    """(start, end) of private keys with their material.

    A block ends with its END line if base64 is most of what lies between, else
    with the last line of base64 that follows; if none does, with the BEGIN line.
    """
    edges = list(_EDGE.finditer(text))
    out = []
    for m, after in zip(edges, [*edges[1:], None]):
        if m.group(1) != "BEGIN":
            continue
        end = m.end()
        stop = after.start() if after else len(text)
        if after and after.group(1) == "END":
            between = text[end:stop]
            if 2 * sum(len(x) for x in _BASE64.findall(between)) >= len(between):
                out.append((m.start(), after.end()))
                continue
        at = _HEAD.match(text, end, stop).end()
        while line := _LINE.match(text, at, stop):
            end = at = line.end()
        if end > m.end() and (last := _LAST.match(text, end, stop)):
            end = last.end()
        out.append((m.start(), end))
    return out


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what may be a secret, without overlaps, in text order."""
    found = []
    stop = 0  # end of the last value's run, read once however many names are in it
    for m in _NAME.finditer(text):
        if v := _VALUE.match(text, m.end()):
            if v.end(1) > stop:
                stop = _RUN.match(text, v.end(1)).end()
            found.append((v.start(1), stop, "assigned"))
    for kind, pattern in _KNOWN:
        found += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    found += [(*x, "private-key") for x in private_keys(text)]
    for m in _MIXED.finditer(text):
        s = m.group()
        if any(c.isdigit() for c in s) and any(c.isalpha() for c in s):
            found.append((m.start(), m.end(), "mixed"))
    rank = {"assigned": 1, "mixed": 2}
    found.sort(key=lambda x: (rank.get(x[2], 0), x[0], -x[1]))
    taken: list[tuple[int, int]] = []  # disjoint, by start
    out = []
    for x in found:  # issuers' formats first, then assignments
        k = bisect.bisect_left(taken, (x[0], x[0]))
        if (k == 0 or taken[k - 1][1] <= x[0]) and (k == len(taken) or taken[k][0] >= x[1]):
            taken.insert(k, (x[0], x[1]))
            out.append(x)
    return sorted(out)


def features(text: str, start: int, end: int, kind: str, path: str | None) -> list[float]:
    s = text[start:end]
    n = len(s)
    kinds = ["d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "o" for c in s]
    counts = Counter(s).values()
    run = best = 1
    for a, b in zip(s, s[1:]):
        run = run + 1 if a == b else 1
        best = max(best, run)
    words = sum(len(w) for w in _WORDS.findall(s))
    marks = sum(len(w) for w in _PLACEHOLDER.findall(s))  # as a share: three letters in some thousand are chance
    letters = sum(k in "lu" for k in kinds)
    before, after = text[max(0, start - 48) : start], text[end : end + 24]
    return [
        math.log2(n), kinds.count("d") / n, kinds.count("l") / n, kinds.count("u") / n, kinds.count("o") / n,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / max(n - 1, 1), -sum(c / n * math.log2(c / n) for c in counts),
        sum(c in "aeiouAEIOU" for c in s) / max(letters, 1), best, words / n, marks / n, all(c in "0123456789abcdefABCDEF" for c in s),
        s.count("/"), s.count("."), kind == "assigned", bool(_NEAR_SECRET.search(before)), bool(_NEAR_HARMLESS.search(before) or _NEAR_HARMLESS.search(after)),
        before[-1:] in "\"'`" and after[:1] in "\"'`" and after[:1] != "", bool(path and _PATH_HARMLESS.search(path)), kind not in ("assigned", "mixed"), bool(_UUID.match(s)),
    ]


class Forest:
    """Trees as arrays; a leaf has feature -1 and the share of secrets among its findings."""

    def __init__(self, trees: list[tuple]):
        self.trees = trees

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 10, least: int = 2, seed: int = 7) -> Forest:
        rng = np.random.default_rng(seed)
        some = max(1, int(math.sqrt(x.shape[1])) + 1)

        def grow(rows: np.ndarray) -> tuple:
            feature, threshold, left, right, share = [], [], [], [], []

            def node(rows: np.ndarray, level: int) -> int:
                k = len(feature)
                p = y[rows].mean()
                for column, value in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1), (share, p)):
                    column.append(value)
                if level == depth or len(rows) < 2 * least or p in (0, 1):
                    return k
                best = (2 * p * (1 - p) * len(rows) - 1e-9, None, None)
                for f in rng.choice(x.shape[1], some, replace=False):
                    v = x[rows, f]
                    for t in np.unique(np.quantile(v, np.linspace(0.05, 0.95, 12))):
                        low = v <= t
                        a = int(low.sum())
                        if least <= a <= len(rows) - least:
                            q, r = y[rows[low]].mean(), y[rows[~low]].mean()
                            gini = 2 * q * (1 - q) * a + 2 * r * (1 - r) * (len(rows) - a)
                            if gini < best[0]:
                                best = (gini, f, t)
                if best[1] is not None:
                    low = x[rows, best[1]] <= best[2]
                    feature[k], threshold[k] = int(best[1]), float(best[2])
                    left[k], right[k] = node(rows[low], level + 1), node(rows[~low], level + 1)
                return k

            node(rows, 0)
            return tuple(map(np.array, (feature, threshold, left, right, share)))

        return cls([grow(rng.integers(0, len(y), len(y))) for _ in range(trees)])

    def score(self, x: np.ndarray) -> np.ndarray:
        """The share of trees that call each row a secret."""
        votes = np.zeros(len(x))
        for feature, threshold, left, right, share in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := feature[at] >= 0).any():
                rows = np.flatnonzero(inner)
                f = feature[at[rows]]
                at[rows] = np.where(x[rows, f] <= threshold[at[rows]], left[at[rows]], right[at[rows]])
            votes += share[at] >= 0.5
        return votes / max(len(self.trees), 1)


def labelled_findings(n: int = TRAIN_FINDINGS, seed: int = 11) -> list[tuple[str, str, str, str, str, int]]:
    """(before, candidate, after, kind, path, label) written by rule, half of them secrets."""
    r = random.Random(seed)
    hexa, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    pick = lambda s, k: "".join(r.choice(s) for _ in range(k))
    filler = lambda: " ".join(pick("etaoinshrdlu", r.randint(2, 9)) for _ in range(r.randint(0, 6)))
    word = lambda: r.choice(DICTIONARY)
    secret_name = lambda: r.choice(["token", "secret", "password", "api_key", "apiKey", "access_key", "SECRET_KEY", "auth_token", "client_secret", "db_password", "passwd"])
    other_name = lambda: r.choice(["commit", "hash", "sha256", "md5", "checksum", "integrity", "uuid", "id", "digest", "revision", "build", "etag", "src", "image", "file", "trace_id"])
    paths = lambda good: r.choice(["", "src0", "web", "src/app/config.py", "settings.py", ".env"] if good else ["", "src0", "web", "tests/test_auth.py", "docs/example.md", "package-lock.json", "fixtures/a.json"])

    def pem():
        kind, body = r.choice(["RSA ", "EC ", "OPENSSH ", ""]), pick(alnum + "+/", r.choice([0, r.randint(100, 3000)]))
        return f"-----BEGIN {kind}PRIVATE KEY-----" + "".join("\n" + body[k : k + 64] for k in range(0, len(body), 64)) + (f"\n-----END {kind}PRIVATE KEY-----" if body else "")

    def loose():  # what stands before a secret that no listed name is assigned
        return r.choice(["Authorization: Bearer ", "Authorization: Basic ", "authorization: ", "Bearer ", "X-Auth: ", "auth ", "login ", "the token is ", "credentials are ", "use the secret ", "passwd root "])

    out = []
    for k in range(n):
        q = r.choice(['"', "'", ""])
        sep = r.choice([" = ", "=", ": "])
        if k % 8 == 1:
            bare = r.random() < 0.2  # hex without such words is not told from hashes
            value = r.choice([lambda: pick(alnum, r.randint(24, 80)), lambda: pick(alnum + "_-", r.randint(24, 80)), lambda: pick(alnum + "+/", r.randint(24, 400)) + r.choice(["", "=", "=="]), lambda: pick(alnum if bare else hexa, r.choice([32, 40, 64]))])()
            out.append((f"{filler()} {r.choice(['curl -u admin:', 'https://user:', 'x: ', '']) if bare else loose()}{r.choice(['', q])}", value, f"{q} {filler()}", "mixed", paths(r.random() < 0.9), 1))
            continue
        if k % 2:
            value = r.choice([lambda: pick(hexa, r.choice([32, 40, 40, 64])), lambda: pick(alnum, r.randint(16, 48)), lambda: pick(alnum + "+/", r.randint(24, 60)) + r.choice(["", "=", "=="]), lambda: pick(alnum + "!@#%^&-_", r.randint(10, 20)), lambda: pick(alnum + r.choice(["", "+/", "-_."]), r.randint(61, 6000)), lambda: ""])()
            if value:
                out.append((f"{filler()} {secret_name()}{sep}{q}", value, f"{q} {filler()}", "assigned", paths(r.random() < 0.9), 1))
            else:
                kind, value = r.choice([("aws-key-id", "AKIA" + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16)), ("github", "ghp_" + pick(alnum, 36)), ("stripe", "sk_live_" + pick(alnum, 24)), ("slack", f"xoxb-{pick('0123456789', 12)}-{pick(alnum, 24)}"), ("google", "AIza" + pick(alnum, 35)), ("jwt", f"eyJ{pick(alnum, 20)}.eyJ{pick(alnum, 40)}.{pick(alnum, 43)}"), ("private-key", pem())])
                out.append((f"{filler()} {r.choice([secret_name(), word(), ''])}{sep}{q}", value, f"{q} {filler()}", kind, paths(r.random() < 0.9), 1))
            continue
        kind = r.choice(["placeholder", "hash", "uuid", "identifier", "path", "environment", "words", "number", "base64", "sentence"])
        if kind == "placeholder":
            row = f"{secret_name()}{sep}{q}", r.choice(["YOUR_API_KEY_HERE", "xxxxxxxxxxxxxxxx", "changeme123", "your-secret-token", "<insert-token>", "example_password_1", "abcdef1234567890", "REDACTED_VALUE", "dummy-token-value", "0" * r.randint(8, 40), "x" * r.randint(8, 40)]), "assigned"
        elif kind == "hash":
            row = f"{r.choice([other_name() + sep, 'id ', 'etag: ', ''])}{q}", pick(hexa, r.choice([32, 40, 64])), "mixed"
        elif kind == "uuid":
            row = f"{r.choice([other_name(), 'token'])}{sep}{q}", "-".join(pick(hexa, k) for k in (8, 4, 4, 4, 12)), "mixed"
        elif kind == "identifier":
            row = f"{filler()} ", "".join(word().title() for _ in range(r.randint(3, 6))) + r.choice(["", "2", "V1", "64"]), "mixed"
        elif kind == "path":
            row = f"{r.choice([other_name(), 'see'])}{sep}{q}", "/".join(word() for _ in range(r.randint(3, 6))) + r.choice(["/v1", "/2024", "1"]), "mixed"
        elif kind == "environment":
            row = f"{secret_name()}{sep}", r.choice(["os.environ", "process.env.API_KEY", "${API_TOKEN}", "getenv", "config.get", "settings.SECRET_KEY", "self.password", "request.token", "user.password"]) + r.choice(["", "_1"]), "assigned"
        elif kind == "words":
            row = f"{secret_name()}{sep}{q}", r.choice(["_", "-", ""]).join(word() for _ in range(r.randint(2, 4))), "assigned"
        elif kind == "number":
            row = f"{other_name()}{sep}", pick("0123456789", r.randint(20, 30)) + r.choice(["L", "n", "px"]), "mixed"
        elif kind == "base64":
            row = f"{r.choice(['src', 'image', 'integrity', 'href'])}{sep}{q}data:image/png;base64,", pick(alnum + "+/", r.randint(60, 400)), "mixed"
        else:
            row = f"the {secret_name()}: ", r.choice(["required", "necessary", "incorrect", "optional", "whatever", "protected", "forgotten", "something"]), "assigned"
        out.append((f"{filler()} {row[0]}", row[1], f"{q} {filler()}", row[2], paths(r.random() < 0.5), 0))
    return out


def fit(findings: list[tuple[str, str, str, str, str, int]], most: int = TRAIN_FINDINGS) -> Forest:
    """A forest from (before, candidate, after, kind, path, label); at most `most` of them are read."""
    rows = findings[:most]
    x = np.array([features(b + c + a, len(b), len(b) + len(c), kind, path) for b, c, a, kind, path, _ in rows], float).reshape(-1, len(FEATURES))
    return Forest.fit(x, np.array([r[-1] for r in rows], float))


@lru_cache(1)
def default_forest() -> Forest:
    return fit(labelled_findings())


def judged(text: str | None, path: str | None, forest: Forest, threshold: float = THRESHOLD) -> list[tuple]:
    """(start, end, kind, score, is_secret) in code points, in text order."""
    found = candidates(text) if text else []
    if not found:
        return []
    scores = forest.score(np.array([features(text, *c, path) for c in found], float))
    return [(*c, float(s), bool(s >= threshold)) for c, s in zip(found, scores)]


def scan(docs: DataFrame, forest: Forest | None = None, key: str = "doc_id", text: str = "text", path: str | None = "source", threshold: float = THRESHOLD) -> DataFrame:
    """A row for each candidate: key, start, end, kind, score, is_secret, sha256.

    Positions count code points; the string itself is not shown, only its hash.
    Null and empty texts have no rows, repeated documents each have theirs, also
    without a key; texts of any length are searched whole, an empty table gives
    no row, and other columns are not read.  Without the path column, or where
    it is null, the path speaks for nothing.
    """
    ship(docs.sparkSession)
    forest = forest or default_forest()
    where = F.col(path).cast("string") if path in docs.columns else F.lit(None).cast("string")
    picked = docs.select(F.col(key).alias("key"), F.col(text).cast("string"), where)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rows = []
                for k, (t, p) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                    rows += [(k, *f, hashlib.sha256(t[f[0] : f[1]].encode()).hexdigest()) for f in judged(t, p, forest, threshold)]
                if rows:
                    k, *rest = zip(*rows)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(k)), *map(pa.array, rest)], ["key", "start", "end", "kind", "score", "is_secret", "sha256"])

    kind = docs.schema[key].dataType.simpleString()
    return picked.mapInArrow(run, f"key {kind}, start bigint, end bigint, kind string, score double, is_secret boolean, sha256 string").withColumnRenamed("key", key)


MASK = "[SECRET]"


def redact(docs: DataFrame, forest: Forest | None = None, text: str = "text", path: str | None = "source", size: str | None = "n_chars") -> DataFrame:
    """The documents with every secret replaced by MASK, and their size column brought up to date.

    All columns stay, whatever their names; null and empty texts and texts
    without a secret are as they were, and so is an empty table.
    """
    ship(docs.sparkSession)
    forest = forest or default_forest()
    names, schema = docs.columns, docs.schema
    at = names.index(text)
    of = names.index(path) if path in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                b = whole.slice(begin, 256)
                out, changed = [], []
                for t, p in zip(b.column(at).to_pylist(), b.column(of).to_pylist() if of is not None else [None] * b.num_rows):
                    hits = [f for f in judged(t, None if p is None else str(p), forest) if f[-1]]
                    changed.append(bool(hits))
                    for s, e, *_ in reversed(hits):
                        t = t[:s] + MASK + t[e:]
                    out.append(t)
                cols = list(b.columns)
                if any(changed):
                    cols[at] = pa.array(out, b.schema.field(at).type)
                    if size in names:
                        k = names.index(size)
                        cols[k] = pa.array([len(t) if c else n for t, c, n in zip(out, changed, cols[k].to_pylist())], b.schema.field(k).type)
                yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(run, schema)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets masked: no row goes, null and empty texts stay as they are."""
    return redact(docs)


QUERIES = {"op8_secret_scan": op8_secrets}
