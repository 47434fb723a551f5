"""Plain restatements of the operators' contracts, for comparison on small inputs."""

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def near_duplicates(rows):
    """id -> (set size, smallest id reachable), comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text, items, window=10):
    """(words, hit words, item ids) of one document."""
    words = item_words(text)
    hit, found = set(), set()
    for item, phrase in items:
        p = item_words(phrase)
        for w in [p] if 0 < len(p) < window else [p[i : i + window] for i in range(len(p) - window + 1)]:
            for i in range(len(words) - len(w) + 1):
                if words[i : i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    found.add(item)
    return len(words), len(hit), found


def luhn(digits):
    doubled = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def personal_data(text):
    """The base spans by the patterns as they stand."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(s, e, ("email", "ip", "card", "phone")[k]) for s, k, e in sorted(out)]


def mod97(text):
    """Remainder of the account number, digit by digit."""
    rest = 0
    for c in text[4:] + text[:4]:
        for d in str(int(c, 36)):
            rest = (rest * 10 + int(d)) % 97
    return rest == 1


def near_words(text, start, end):
    out, word = set(), ""
    for c in text[max(0, start - 40) : start] + " " + text[end : end + 40] + " ":
        if c.isalpha():
            word += c.lower()
        else:
            out.add(word)
            word = ""
    return out


#: Prior score, gain of the kind's check, words for and words against, as the operator's tables say.
SCORES = {
    "iban": (0.25, {"iban", "account", "bank", "konto", "compte", "cuenta", "transfer"}, {"order", "serial", "tracking", "part"}),
    "ssn": (0.4, {"ssn", "social", "security", "taxpayer"}, {"order", "part", "serial", "model", "version"}),
    "key": (0.7, {"key", "token", "secret", "credentials", "access"}, {"example", "placeholder", "dummy"}),
    "password": (0.2, {"login", "user", "username", "credentials", "account"}, {"example", "placeholder", "dummy", "minimum", "forgot"}),
}


def added_spans(text):
    """Further kinds from tokens between white space, for texts in which spans stand alone: {(start, end, kind): score}."""
    found = {}
    for m in re.finditer(r"\S+", text):
        word, start = m.group(), m.start()
        kinds = []
        if re.fullmatch(r"[A-Z]{2}\d{2}[A-Z0-9]{11,30}", word) and mod97(word):
            kinds.append(("iban", start, True))
        if re.fullmatch(r"\d{3}-\d{2}-\d{4}", word) and word[:3] not in ("000", "666") and word[0] != "9" and word[4:6] != "00" and word[7:] != "0000":
            kinds.append(("ssn", start, False))
        if re.fullmatch(r"AKIA[A-Z0-9]{16}|ghp_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}", word):
            kinds.append(("key", start, False))
        if re.match(r"(?i)(password|api_key)=.{6,}", word):
            value = word.index("=") + 1
            kinds.append(("password", start + value, bool(re.search("[a-zA-Z]", word[value:]) and re.search(r"\d", word[value:]))))
        for kind, at, passed in kinds:
            prior, good, bad = SCORES[kind]
            near = near_words(text, at, m.end())
            value = prior + 0.5 * passed + 0.2 * bool(near & good) - 0.3 * bool(near & bad)
            if value >= 0.5 - 1e-12:
                found[at, m.end(), kind] = min(1.0, max(0.0, value))
    return found


MASK = (1 << 64) - 1


def mix64(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def word_sum(word):
    """Polynomial over randomised byte values, in plain integers."""
    total = 0
    for k, b in enumerate(word):
        total += mix64((b + 1) * 0x9E3779B97F4A7C15 & MASK) * pow(0xD1342543DE82EF95, k, 1 << 64)
    return total & MASK


def text_features(text):
    """Hashes of the distinct words and of their prefixes of 4, 5 and 6 bytes."""
    out = set()
    for word in item_words(text):
        raw = word.encode()
        out.add(mix64(word_sum(raw)))
        out |= {mix64((word_sum(raw[:k]) + k) & MASK) for k in (4, 5, 6) if len(raw) > k}
    return out
