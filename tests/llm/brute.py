"""Plain Python forms of the operators, for small inputs."""

from __future__ import annotations


def repeated_lines(docs: dict[int, str | None], min_words: int) -> dict[int, set[int]]:
    """Lines inside a run of min_words words that has an earlier copy which does not overlap it, and blank lines after them."""
    seqs = {}
    for doc in sorted(docs):
        lines = (docs[doc] or "").split("\n")
        seqs[doc] = [(i, line.strip(), len(line.split())) for i, line in enumerate(lines) if line.split()]
    seen: dict[tuple, tuple[int, int]] = {}
    runs = []
    for doc, lines in seqs.items():
        for a in range(len(lines)):
            total = 0
            for b in range(a, len(lines)):
                total += lines[b][2]
                if total >= min_words:
                    key = tuple(x[1] for x in lines[a : b + 1])
                    seen.setdefault(key, (doc, a))
                    runs.append((doc, a, b, key))
    deleted: dict[int, set[int]] = {}
    for doc, a, b, key in runs:
        first_doc, first = seen[key]
        if first_doc != doc or first + (b - a + 1) <= a:
            low = seqs[doc][a][0]
            high = seqs[doc][b + 1][0] if b + 1 < len(seqs[doc]) else len(docs[doc].split("\n"))
            deleted.setdefault(doc, set()).update(range(low, high))
    return deleted


def components(nodes, links) -> dict:
    """Smallest reachable node of each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text: str | None, words: int = 5) -> set:
    parts = (text or "").encode().lower().split()
    if not parts:
        return set()
    if len(parts) < words:
        return {tuple(parts)}
    return {tuple(parts[i : i + words]) for i in range(len(parts) - words + 1)}


def jaccard(docs: dict[int, str | None], percent: int = 80) -> dict[int, tuple[int, int]]:
    """(set size, component) of each document."""
    sets = {d: shingles(t) for d, t in docs.items()}
    ids = sorted(docs)
    links = []
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                if 100 * len(x & y) >= percent * len(x | y):
                    links.append((a, b))
    found = components(ids, links)
    return {d: (len(sets[d]), found[d]) for d in ids}


def benchmark_words(text: str | None) -> list[bytes]:
    """Words of ASCII digits, letters and all bytes above ASCII."""
    words, own = [], bytearray()
    for byte in (text or "").encode().lower() + b" ":
        if byte >= 0x80 or chr(byte).isalnum():
            own.append(byte)
        elif own:
            words.append(bytes(own))
            own = bytearray()
    return words


def contaminated(docs: dict, items: list[tuple], window: int = 13, share: int = 20) -> dict:
    """(n_words, n_hit, sorted item ids, contaminated) of each document."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = benchmark_words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    sizes = {len(k) for k in windows}
    result = {}
    for doc, text in docs.items():
        w = benchmark_words(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                own = windows.get(tuple(w[i : i + size]))
                if own:
                    hit.update(range(i, i + size))
                    found |= own
        bad = bool(hit) and share * len(hit) >= len(w)
        result[doc] = (len(w), len(hit), sorted(found), bad)
    return result


def greedy_tokens(text: str, vocabulary: set[str]) -> int:
    """Longest match from the left; a character that begins no piece counts as its bytes."""
    text = f" {text}" if text else ""
    longest = max(map(len, vocabulary), default=1)
    at = total = 0
    while at < len(text):
        for end in range(min(len(text), at + longest), at, -1):
            if text[at:end] in vocabulary:
                total, at = total + 1, end
                break
        else:
            total, at = total + len(text[at].encode()), at + 1
    return total


def segmentations(text: str, scores: dict[str, float], unknown: float) -> list[float]:
    """Scores of all segmentations of a whole text, best first."""
    text = f" {text}"
    found: list[float] = []

    def go(at: int, total: float) -> None:
        if at == len(text):
            found.append(total)
            return
        if text[at] not in scores:
            go(at + 1, total + unknown)
        for end in range(at + 1, len(text) + 1):
            if text[at:end] in scores:
                go(end, total + scores[text[at:end]])

    go(0, 0.0)
    return sorted(found, reverse=True)
