"""Plain re-statements of the span reports."""

import hashlib
import re

ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def secrets(text):
    out = [("assign", m) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return out


def private(text):
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append(("card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m))
    return out


def summary(found, kinds):
    rows = sorted((m.start(), kinds.index(k), k, m.end()) for k, m in found)
    joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in rows)
    counts = tuple(sum(r[2] == k for r in rows) for k in kinds)
    return counts + (hashlib.sha256(joined.encode()).hexdigest(),)


OTHER = re.compile(r"[^0-9a-z\x80-\U0010ffff]+")
TOKEN = re.compile(r"(?<![0-9A-Za-z._%+@/-])[A-Za-z._%+/-]*[0-9@][0-9A-Za-z._%+@/-]*")
AROUND = 64


def instance(text):
    return re.sub("[^0-9a-z@]+", "", text.lower())


def fit(text):
    return 7 <= len(text) <= 64 and (len(re.sub("[^0-9]", "", text)) >= 6 or "@" in text)


def gap_class(gap):
    gap = re.sub(r"\s+", " ", gap.translate(str.maketrans("\u201c\u201d`'", '""""')))
    return re.sub(r"[)\]}>]+", ")", re.sub(r"[(\[{<]+", "(", re.sub('"+', '"', gap)))[:8]


def contexts(before, after):
    out = []
    for side, text in (("left", before.lower()), ("right", after.lower())):
        words = [w for w in OTHER.split(text) if w]
        gap = re.search(f"{OTHER.pattern[:-1]}*$" if side == "left" else f"^{OTHER.pattern[:-1]}*", text)[0]
        for k in range(1, min(3, len(words) - (len(text) >= AROUND)) + 1):
            run = words[-k:] if side == "left" else words[:k]
            out.append((side, " ".join(run), gap_class(gap)))
    return out


def linked_secrets(text, scope=200):
    """Sure secrets and weak parts of credentials, by looking at all pairs."""
    from farebox.llm import credentials

    sure = [(m.start(), m.end(), k) for k, m in secrets(text)]
    weak = []
    for kind, pattern in credentials.PARTS.items():
        for m in re.finditer(pattern, text):
            if kind == "key" and not (re.search("[0-9]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[a-z]", m[0]) and not re.search("/.*/.*/", m[0])):
                continue
            if all(m.end() <= s or m.start() >= e for s, e, _ in sure):
                weak.append((m.start(), m.end(), kind))
    found = sure + weak

    def near(a, kinds):
        return any(b is not a and b[2] in kinds and -scope <= max(a[0], b[0]) - min(a[1], b[1]) <= scope for b in found)

    proofs, places = ("key", "assign", "access", "hex"), ("account", "endpoint", "access")
    kept = sure + [x for x in weak if near(x, places if x[2] == "key" else proofs)]
    return sorted((s, e, k) for s, e, k in kept)


def personal(rows, least_seeds=3, least_score=0.6, doubt=0.15):
    """(id, start, end, kind) of sure spans and of those learned from contexts, one round at a time."""
    found = []
    for i, text in sorted(set((i, t or "") for i, t in rows), key=str):
        sure = [(k, m) for k, m in private(text)]
        tokens = [m for m in TOKEN.finditer(text) if all(m.end() <= s.start() or m.start() >= s.end() for _, s in sure)]
        # What lies around a match ends at its neighbours of the same kind, valid or not.
        for kind, m in sure + [("context", m) for m in tokens]:
            every = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"}
            every |= {"card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]", "context": TOKEN.pattern}
            spots = [x.span() for x in re.finditer(every[kind], text)]
            at = spots.index(m.span())
            low = spots[at - 1][0] if at else 0
            high = spots[at + 1][0] if at + 1 < len(spots) else len(text)
            before, after = text[max(low, m.start() - AROUND) : m.start()], text[m.end() : min(high, m.end() + AROUND)]
            found.append((i, text, kind, m, contexts(before, after)))
    known = {instance(m[0]) for _, _, kind, m, _ in found if kind != "context"}
    slots = {}
    for _, _, kind, m, patterns in found:
        for p in patterns:
            slots.setdefault(p, []).append(instance(m[0]) if kind != "context" or fit(m[0]) else None)
    texts = [[w for w in OTHER.split((t or "").lower()) if w] for _, t in rows]

    def uses(run):
        run = run.split(" ")
        return sum(words[j : j + len(run)] == run for words in texts for j in range(len(words)))

    against = {}
    for p, met in slots.items():
        against[p] = sum(x is None for x in met)
        if re.fullmatch(r"[\s.,;!?]*" if p[0] == "left" else r"[\s.,;!?\")]*", p[2]) and len({x for x in met if x}) > least_seeds:
            against[p] += max(uses(p[1]) - len(met), 0)
    while True:
        new = set()
        for p, met in slots.items():
            named = [x for x in met if x]
            good = sum(x in known for x in named)
            if len({x for x in named if x in known}) >= least_seeds:
                if good / (good + against[p] + doubt * (len(named) - good) + 1) >= least_score:
                    new |= set(named) - known
        if not new:
            break
        known |= new
    return {
        (i, m.start(), m.end(), kind)
        for i, _, kind, m, _ in found
        if kind != "context" or (fit(m[0]) and instance(m[0]) in known)
    }
