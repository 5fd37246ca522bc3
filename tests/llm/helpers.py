"""Rows with every awkward case, and brute-force versions of the operators in plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import xxhash

LONG = "lorem ipsum dolor sit amet " * 4000
CLASHES = (
    "key h salt base again class n family root of _n row kind bucket block score held_out "
    "part term size target copies near seen entity taken fp least anchor mine digest flags first "
    "marks fail a b h1 form output"
).split()


def awkward(seed=1, n=60):
    """(doc_id, text): nulls, empty and long texts, ties, repeated rows and ids."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Été", "日本", "it's", "a@b.cz", "+420 123 456 789", "<|endoftext|>"]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 5, 30, 80])))
        rows.append((i, text.replace(" w7 ", "\n")))
    rows += [(n + i, rows[i][1]) for i in range(10)]
    rows += [(n + 20 + i, rows[i][1] + " and more") for i in range(10)]
    rows += [(3, rows[3][1]), (3, "another text under an old id"), (200, None), (201, "")]
    rows += [(202, " \t\n"), (203, LONG), (204, LONG), (None, "no id at all"), (None, None)]
    return rows


def table_of(spark, folder, rows, clashing=True, name="documents"):
    """A documents table written to ``folder``, with columns whose names operators use."""
    columns = {"text": [r[1] for r in rows]}
    lang = ["en", "fr", None]
    data = [
        (r[0], t, lang[i % 3], f"src{i % 4}" if i % 5 else None, None if t is None else len(t))
        for i, (r, t) in enumerate(zip(rows, columns["text"], strict=True))
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(data, schema)
    if clashing:
        frame = frame.selectExpr("*", *[f"'x' as `{c}`" for c in CLASHES])
    frame.repartition(3).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return frame


def labels_of(spark, folder, rows):
    schema = "doc_id long, quality int, toxic int"
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/labels.parquet")


def text_key(value):
    return "" if value is None else str(value)


def collected(frame, columns):
    return sorted((tuple(map(text_key, (r[c] for c in columns))) for r in frame.collect()))


def expected(rows):
    return sorted(tuple(map(text_key, r)) for r in rows)


PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    every = [int(d) for d in reversed(digits)]
    return sum(every[::2] + [sum(divmod(2 * d, 10)) for d in every[1::2]]) % 10 == 0


def personal(text):
    found = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            sound = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if sound:
                found.append((kind, m.start(), m.end()))
    return found


def personal_row(doc_id, text):
    found = personal(text)
    n = Counter(kind for kind, _, _ in found)
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
    digest = hashlib.sha256(joined.encode()).hexdigest()
    return (doc_id, n["email"], n["ip"], n["card"], n["phone"], digest)


def repeats(rows, length=50):
    last = 2**63 - 1
    least = {}
    for doc_id, text in rows:
        data, key = (text or "").encode(), last if doc_id is None else doc_id
        for i in range(len(data) - length + 1):
            piece = data[i : i + length]
            least[piece] = min(least.get(piece, key), key)
    out = []
    for doc_id, text in rows:
        data, key = (text or "").encode(), last if doc_id is None else doc_id
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if least[data[i : i + length]] < key:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near_components(rows, percent=75):
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    lists = defaultdict(list)
    for k, mine in enumerate(sets):
        overlap = Counter(z for s in mine for z in lists[s])
        for s in mine:
            lists[s].append(k)
        for z, c in overlap.items():
            if 100 * c >= percent * (len(mine) + len(sets[z]) - c):
                parent[root(k)] = root(z)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(k)] = min(least.get(root(k), doc_id), doc_id)
    return [(doc_id, len(sets[k]), least.get(root(k))) for k, (doc_id, _) in enumerate(rows)]


def fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def close_components(rows, bits=3):
    prints = [fingerprint(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, mine in enumerate(prints):
        for z in range(k):
            if (mine ^ prints[z]).bit_count() <= bits:
                parent[root(k)] = root(z)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(k)] = min(least.get(root(k), doc_id), doc_id)
    return [(doc_id, f"{prints[k]:016x}", least.get(root(k))) for k, (doc_id, _) in enumerate(rows)]


def middle_row(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    parts = ["".join(units[i:j]) for i, j in ((0, a), (a, b), (b, None))]
    form = "spm" if h[3] % 100 < 50 else "psm"
    output = {"psm": "<P>{0}<S>{2}<M>{1}", "spm": "<S>{2}<P>{0}<M>{1}"}[form].format(*parts)
    sizes = len(parts[0]), len(parts[1])
    if not text or re.search("<[PSM]>", text):
        form, output, sizes = "plain", text, (None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return doc_id, len(units), form, *sizes, sha(output), sha(text)


def audited(rows, labels):
    """Rows of (doc_id, lang, text), and of (doc_id, quality, toxic): the orders played through."""
    key = lambda i: 2**63 - 1 if i is None else i
    least, docs = {}, defaultdict(list)
    for i, _, text in rows:
        least[text or ""] = min(least.get(text or "", key(i)), key(i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    for i, lang, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = "".join(
            name
            for name, fail in zip(
                "ABCDE",
                (
                    len(words) < 200,
                    100 * len(set(words)) < 50 * len(words),
                    100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                    re.search("[#$%&*|]", text),
                    least[text] < key(i),
                ),
                strict=True,
            )
            if fail
        )
        docs[lang or ""].append((fails, i in good, i in toxic))
    out = []
    for part, mine in docs.items():
        shapley, lines = Counter(), []
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order):
                gone = [d for d in left if name in d[0]]
                left = [d for d in left if name not in d[0]]
                shapley[name] += len(gone)
                failing = sum(name in d[0] for d in mine)
                alone = sum(d[0] == name for d in mine)
                lines.append((part, "".join(order), step + 1, name, len(left), len(gone), failing - len(gone), alone,
                              sum(d[1] for d in gone), sum(d[2] for d in gone)))
        out += [(*line, shapley[line[3]]) for line in lines]
    return out


def quality_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered |= set(range(i, i + 8))
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )
