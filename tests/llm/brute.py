"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

from growthloom.llm.secret_ledger import RULES as SECRET_RULES


def secret_spans(text: str | None) -> list[tuple[int, int, int, str]]:
    out = []
    for o, rule in enumerate(SECRET_RULES):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                out.append((m.start(), o, m.end(), rule.kind))
    return sorted(out)


def secret_row(text: str | None) -> tuple[int, int, int, str, str]:
    spans = secret_spans(text)
    base = [s for s in spans if s[1] < 3]
    joined = [",".join(f"{k}:{a}:{b}" for a, _, b, k in part) for part in (base, spans)]
    n = Counter(s[3] for s in base)
    return n["assign"], n["access"], n["hex"], hashlib.sha256(joined[0].encode()).hexdigest(), joined[1]


def url_parts(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def url_rule(host: str, path: str, rules) -> tuple[str | None, str | None]:
    best = (None, None)
    for verdict, rule in rules:
        site, _, start = rule.partition("/")
        if (host == site or host.endswith("." + site)) and path.startswith("/" + start) and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return best


def url_verdicts(urls: list[str | None], rules, context: int = 4, folds: int = 5) -> list[tuple]:
    parts = [url_parts(u) for u in urls]
    said = [url_rule(*p, rules) for p in parts]

    def runs(s: str) -> list[str]:
        padded = "\x02" * context + s + "\x03"
        return [padded[i : i + context + 1] for i in range(len(s) + 1)]

    def fold(s: str) -> int:
        return int(hashlib.md5(s.encode()).hexdigest()[:4], 16) % folds

    counts = {c: [Counter() for _ in range(context + 1)] for c in ("allow", "block")}
    total = {c: [Counter() for _ in range(context + 1)] for c in ("allow", "block")}
    for (h, p), (_, v) in zip(parts, said):
        if v and fold(h + p):
            for run in runs(h + p):
                for k in range(context + 1):
                    counts[v][k][run[context - k :]] += 1
                    total[v][k][run[context - k : context]] += 1
    kinds = {c: [Counter(g[:-1] for g in counts[c][k]) for k in range(context + 1)] for c in counts}

    def log_p(c: str, run: str) -> float:
        prob = 1 / 256
        for k in range(context + 1):
            g = run[context - k :]
            n, t = total[c][k][g[:-1]], kinds[c][k][g[:-1]]
            if n:
                prob = (counts[c][k][g] + t * prob) / (n + t)
        return math.log(prob)

    def score(s: str) -> float:
        return sum(log_p("allow", r) - log_p("block", r) for r in runs(s)) / (len(s) + 1)

    scores = [score(h + p) for h, p in parts]
    held = {c: [x for x, (h, p), (_, v) in zip(scores, parts, said) if v == c and not fold(h + p)] for c in counts}
    bound = None
    if all(held.values()) and all(total[c][0] for c in total):
        mean = {c: sum(x) / len(x) for c, x in held.items()}
        spread = {c: math.sqrt(max(0.0, sum(y * y for y in x) / len(x) - mean[c] ** 2)) + 1e-9 for c, x in held.items()}
        bound = (mean["allow"] * spread["block"] + mean["block"] * spread["allow"]) / (spread["allow"] + spread["block"])
    return [(h, p, r, v or ("allow" if bound is None or x >= bound else "block")) for (h, p), (r, v), x in zip(parts, said, scores)]


def shingles(text: str | None, width: int = 5) -> set:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    width = min(width, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def duplicate_classes(texts: list[str | None], threshold: float = 0.8) -> list[int]:
    """Class (least position) of each text, over all pairs that share a shingle."""
    sets = [shingles(t) for t in texts]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    parent = list(range(len(texts)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    common = Counter((a, b) for held in holders.values() for i, a in enumerate(held) for b in held[i + 1 :])
    for (a, b), n in common.items():
        if n >= threshold * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]
