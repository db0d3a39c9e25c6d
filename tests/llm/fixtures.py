"""Small inputs that hold the awkward cases, and brute-force statements of the operators."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 3000


def odd_documents(spark, extra: bool = True):
    """Nulls in every column, empty and blank texts, a very long text, repeated rows, ties, an extra column with a clashing name."""
    passage = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, passage, "en", "a", 1), (2, passage + " thirteen", "en", "a", 1), (3, passage.upper(), None, None, None), (4, None, "en", "a", 0),
            (5, "", "en", "a", 0), (6, " \n\t ", "en", "a", 3), (7, LONG, "en", "a", len(LONG)), (8, "one", "en", "a", 3), (9, "ONE", "en", "a", 3),
            (10, "password = hunter2hunter2 mail a@b.org +1 234 567 8901 0123456789abcdef01", "en", "b", 9), (11, passage, "en", "a", 1), (11, passage, "en", "a", 1),
            (None, passage, "en", "a", 1), (None, "quite another text with no copy at all", "en", "a", 1), (12, "é😀 token: 'Abcdefgh12345678' 10.20.30.40 4111 1111 1111 1111", "fr", "b", 9),
            (13, "x" * 40_000, "en", "a", 40_000), (14, "Released under the MIT License.\n\nyou idiot moron", "en", "a", 4)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        from pyspark.sql import functions as F
        df = df.withColumn("row", F.lit("clash")).withColumn("score", F.lit(1.5)).withColumn("block", F.array(F.lit(1)))
    return df


def empty(df):
    return df.limit(0)


# ------------------------------------------------------------------ n-gram join
def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles(w, k=5):
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(texts):
    """[(doc_id, text)] -> list of (doc_id, n, component) by comparing all pairs that share a shingle."""
    sets = [shingles(words(t)) for _, t in texts]
    places = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            places[g].append(i)
    common = Counter(p for v in places.values() for p in itertools.combinations(v, 2))
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for (a, b), o in common.items():
        if 100 * o >= 75 * (len(sets[a]) + len(sets[b]) - o):
            up[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(texts):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(sets[i]), least.get(find(i), d)) for i, (d, _) in enumerate(texts)]


# ------------------------------------------------------------------------ spans
SECRETS = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)),
           ("access", re.compile("AKIA[A-Z0-9]+")), ("hex", re.compile("[0-9a-f]+"))]
PERSONAL = [("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")), ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
            ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")), ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def personal_ok(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def secret_ok(kind, m):
    return len(m[2] if kind == "assign" else m[0]) >= {"assign": 12, "access": 18, "hex": 16}[kind]


def base(patterns, ok, text):
    found = sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(patterns) for m in p.finditer(text or "")
                   if ok(k, m if patterns is SECRETS else m[0]))
    told = ",".join(f"{k}:{s}:{e}" for s, _, e, k in found)
    return Counter(k for *_, k in found), hashlib.sha256(told.encode()).hexdigest(), told


# -------------------------------------------------------------- decontamination
def item_matches(docs, items, threshold=0.75):
    """{(doc_id, item_id)}: every item-sized window of every document against the items that share a shingle with it."""
    split = lambda t: re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", (t or "").lower())
    w = {i: split(t) for i, t in items}
    sets = {i: shingles(x) for i, x in w.items()}
    df = Counter(g for s in sets.values() for g in s)
    weight = lambda g: math.log(1 + len(w) / df[g]) if g in df else math.log(1 + len(w))
    has = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            has[g].add(i)
    out = set()
    for d, text in docs:
        x = split(text)
        for i in {i for k in range(len(x)) for g in (tuple(x[k:k + 5]),) for i in has.get(g, ())}:
            for k in range(max(1, len(x) - len(w[i]) + 1)):
                s = shingles(x[k:k + len(w[i])])
                both = sum(map(weight, sets[i] & s))
                if both and both / sum(map(weight, sets[i] | s)) >= threshold:
                    out.add((d, i))
                    break
    return out
