"""Plain single-machine versions of the text operators, for the tests."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def exact_groups(rows):
    """(id, text) rows -> per row (id, keep_id, group_size, digest)."""
    groups = defaultdict(list)
    plain = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    for (i, t), p in zip(rows, plain, strict=True):
        groups[p].append((-len(t or ""), i is None, i or 0, i))
    return [(i, min(groups[p])[3], len(groups[p]), hashlib.sha256(p.encode()).hexdigest())
            for (i, _), p in zip(rows, plain, strict=True)]


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


def gram_bucket(gram, bits=16):
    code = len(gram)
    for byte in gram:
        code = code * 0x01000193 & 0xFFFFFFFF ^ byte
    return (code * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - bits)


def buckets(text, n):
    raw = (text or "").encode()
    return [gram_bucket(raw[i:i + n]) for i in range(len(raw) - n + 1)]


def shingles(text, size=4):
    words = WORD.findall(lower_ascii(text))
    if len(words) >= size:
        return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def near_groups(rows, size=4, percent=80):
    """(id, text) rows -> {id: component_id}, all pairs of sets that share a shingle."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    index = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            index[x].append(i)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in index[x] if j > i)
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        least[r] = doc if r not in least or least[r] is None else min(least[r], doc if doc is not None else least[r])
    return [(doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)]


def near_vectors(rows, threshold=0.9):
    """(id, vector) rows -> (id, n_links, component_id), all pairs of vectors."""
    import math

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        size = math.hypot(*map(float, v))
        return [float(x) / size for x in v]

    units = [unit(v) for _, v in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(units):
        for j in range(i):
            if a and units[j] and sum(x * y for x, y in zip(a, units[j], strict=False)) >= threshold:
                links[i], links[j] = links[i] + 1, links[j] + 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        least.setdefault(find(i), []).append(key)
    least = {r: min((k for k in ks if k is not None), default=None) for r, ks in least.items()}
    return [(key, links[i], least[find(i)]) for i, (key, _) in enumerate(rows)]


def damaged_turns(rows):
    """(conv, turn, role, text) rows -> {conv: [(turn, role, text), ...] in order}."""
    import zlib
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        mine = out[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        mine += [(turn, role, text)] * (2 if kind == 3 else 1)
    for mine in out.values():
        mine.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1],
                                 hashlib.sha256(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).digest()))
    return out


def cheapest(rows):
    """Rows (initial, fault) -> (cost, edits): every edit string is tried, the
    cheapest first (a search by cost, then by letters)."""
    import heapq
    due = {"": "u", "s": "u", "u": "a", "a": "u"}
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, edits, i, last = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, edits
        if (i, last) in seen:
            continue
        seen.add((i, last))
        heapq.heappush(heap, (cost + 5, edits + "I", i, due[last]))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 2, edits + "D", i + 1, last))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                heapq.heappush(heap, (cost + 1 + extra, edits + "R", i + 1, due[last]))
                if initial == due[last] or (last == "" and initial == "s"):
                    heapq.heappush(heap, (cost + extra, edits + "K", i + 1, initial))


def faults(mine):
    seen, out = set(), []
    for _, role, text in mine:
        plain = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not plain else "duplicate" if (role, text) in seen
                   else "truncated" if plain[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def audit(mine):
    """One conversation's rows -> the columns of the audit."""
    fault = faults(mine)
    turns = [t for t, _, _ in mine if t is not None]
    initials = [r[:1] for _, r, _ in mine]
    cost, edits = cheapest(list(zip(initials, fault, strict=True)))
    said, at, last = [], 0, ""
    for letter in edits:
        role, text = ("", "") if letter == "I" else mine[at][1:]
        at += letter != "I"
        if letter == "D":
            continue
        last = {"u": "a"}.get(last, "u") if letter != "K" else role[:1]
        said.append((role if letter == "K" else {"u": "user", "a": "assistant"}[last], text))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, fault.count("blank"), fault.count("duplicate"),
            fault.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, edits, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()), said


def spelling(rows):
    """(id, text) rows -> {word: (form, root, n, n_near, form_n)}."""
    import zlib
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            cut = h % len(word)
            count[word[:cut] + word[cut + 1:] if h % 97 == 0 else word] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    near = defaultdict(set)
    for w in words:
        for i in range(len(w) + 1):
            shorter = w[:i] + w[i + 1:]
            if i < len(w) and shorter in words:
                near[w].add(shorter), near[shorter].add(w)
    wild = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            wild[w[:i], w[i + 1:]].add(w)
    for group in wild.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words.get(form[w]))
    return out
