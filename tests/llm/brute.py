"""Plain versions of what the operators compute."""

import hashlib
import re
from collections import defaultdict


def reach(ids, links):
    """Smallest id that each id reaches over the links."""
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_classes(texts):
    """id -> (set size, component) of {id: text}."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    holders, common = defaultdict(list), defaultdict(int)
    for i, s in sets.items():
        for g in s:
            for j in holders[g]:
                common[i, j] += 1
            holders[g].append(i)
    links = [(i, j) for (i, j), n in common.items() if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n)]
    least = reach(texts, links)
    return {i: (len(sets[i]), least[i]) for i in texts}


def cut(texts, length=50):
    """id -> (bytes, removed, spans, digest) of {id: text}."""
    first = {}
    data = {i: (t or "").encode() for i, t in texts.items()}
    for i in sorted(data):
        for p in range(len(data[i]) - length + 1):
            first.setdefault(data[i][p : p + length], i)
    out = {}
    for i, b in data.items():
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def personal(text):
    """Base spans by the four patterns as they are written."""
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out
