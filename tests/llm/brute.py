"""Plain Python versions of the operators, over a list of (doc_id, text)."""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def crc(doc_id, divisor):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % divisor


class Groups:
    def __init__(self):
        self.of = {}

    def find(self, x):
        self.of.setdefault(x, x)
        while self.of[x] != x:
            x = self.of[x]
        return x

    def join(self, a, b):
        self.of[self.find(a)] = self.find(b)


def simhash(text):
    w = words(lower(text))
    grams = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if grams and 2 * sum(h >> b & 1 for h in hashes) > len(grams))


def simhash_components(prints):
    """Class of each distinct fingerprint."""
    prints, groups = sorted(set(prints)), Groups()
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 3:
                groups.join(a, b)
    return {p: groups.find(p) for p in prints}


def paragraph_likeness(a, b):
    a, b = (set(Counter(t.split("\n")).items()) if t else set() for t in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(docs):
    """(doc_id, text, edited text, next text) for distinct ids."""
    docs = sorted((i, t or "") for i, t in docs)
    for k, (i, t) in enumerate(docs):
        after, half = docs[(k + 1) % len(docs)][1], len(t) // 2
        yield i, t, t[: len(t) - half] + after[:half], after


def unigram(docs):
    """doc_id -> (held_out, n_tokens, n_known, train_tokens, base_score)."""
    tokens = {i: [*words(lower(t)), "\n"] for i, t in docs}
    counts = Counter()
    for i, found in tokens.items():
        if crc(i, 7) != 2:
            counts.update(found)
    total, kinds = sum(counts.values()), len(counts)
    return {
        i: (
            crc(i, 7) == 2, len(found), sum(counts[w] > 0 for w in found), total,
            sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in found),
        )
        for i, found in tokens.items()
    }


def repeated_paragraphs(docs, least=21, similar=0.8):
    """(doc_id, line) -> (first occurrence, class size, removed)."""
    at = defaultdict(list)
    for i, t in docs:
        for n, line in enumerate((t or "").split("\n")):
            w = words(lower(line))
            if len(w) >= least:
                at[" ".join(w)].append((i, n))
    texts, sets, holders, groups = list(at), [], defaultdict(list), Groups()
    for k, p in enumerate(texts):
        w = p.split(" ")
        sets.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)})
        shared = Counter(j for g in sets[-1] for j in holders[g])
        for j, both in shared.items():
            if both >= similar * (len(sets[k]) + len(sets[j]) - both):
                groups.join(k, j)
        for g in sets[-1]:
            holders[g].append(k)
    classes = defaultdict(list)
    for k, p in enumerate(texts):
        classes[groups.find(k)] += at[p]
    return {
        place: (min(c), len(c), place != min(c)) for c in classes.values() if len(c) > 1 for place in c
    }


def line_runs(text, least):
    """The shortest runs of several lines with ``least`` words, blank lines left out, one from each line on."""
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    out = set()
    for k in range(len(lines)):
        words, n = 0, k
        while n < len(lines) and words < least:
            words, n = words + len(WORDS.findall(lines[n])), n + 1
        if words >= least and n - k > 1:
            out.add("\n".join(lines[k:n]))
    return out


def line_removals(docs, patience, rare, common, long, least):
    """doc_id -> numbers of the lines to delete, for distinct ids in ascending order."""
    first, order = {}, []
    for i, t in docs:
        if t not in first:
            first[t] = i
            order.append((i, t))
    holders, text_of = defaultdict(list), dict(order)
    for i, t in order:
        for line in {x for x in t.split("\n") if len(x) >= long}:
            holders[line].append(i)
    earliest = {}
    for i, t in order:
        for run in line_runs(t, least):
            earliest.setdefault(run, i)
    out = {}
    for i, t in docs:
        lines = t.split("\n")
        if first[t] != i and t:
            out[i] = list(range(len(lines)))
            continue
        links = defaultdict(lambda: [0, 0, 0])
        for line in set(lines):
            held = holders.get(line, [i])
            if held[0] != i:
                links[held[0]][0] += len(held) <= rare
                links[held[0]][1] += 1
                links[held[0]][2] += len(WORDS.findall(line))
        for run in line_runs(t, least):
            if earliest[run] != i:
                links[earliest[run]][2] += least
        gone = set()
        for partner, (few, all_, words) in links.items():
            if few or all_ >= common or words >= least:
                block = []
                for k in [*patience(text_of[partner].split("\n"), lines), -9]:
                    if block and k != block[-1] + 1:
                        gone |= set(block) if any(len(lines[x]) >= long for x in block) else set()
                        block = []
                    block.append(k)
        out[i] = sorted(gone)
    return out


def bpe(word, ranks):
    """Merge the leftmost pair of lowest rank until none is left; pieces of the word."""
    parts = list(word)
    while len(parts) > 1:
        found = [(ranks.get((a, b), math.inf), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, k = min(found)
        if rank == math.inf:
            break
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return parts


def targets(sizes, weights=(5, 2, 1), top=3):
    """Target per source (None last), by repeated sharing of what is above the cap."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    open_, left, out = set(names), sum(sizes.values()), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > top * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = top * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def ppm_counts(train, order):
    """Per context length: context -> counts of the bytes after it."""
    pad, counts = b"\n" * order, [defaultdict(Counter) for _ in range(order + 1)]
    for t in train:
        t = pad + t
        for i in range(order, len(t)):
            for k in range(order + 1):
                counts[k][t[i - k : i]][t[i]] += 1
    return counts


def ppm(train, text, order, counts=None):
    """log10 probability of ``text`` byte by byte, with exclusion; ``train`` and ``text`` end in a line end."""
    pad, counts = b"\n" * order, counts or ppm_counts(train, order)
    text, total = pad + text, 0.0
    for i in range(order, len(text)):
        excluded = set()
        for k in range(order, -1, -1):
            seen = {s: n for s, n in counts[k].get(text[i - k : i], {}).items() if s not in excluded}
            if not seen:
                continue
            mass = sum(seen.values()) + len(seen)
            if text[i] in seen:
                total += math.log10(seen[text[i]] / mass)
                break
            total += math.log10(len(seen) / mass)
            excluded |= set(seen)
        else:
            total -= math.log10(256 - len(excluded))
    return total


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def forward_backward(scores, transitions):
    """Marginals and expected transitions of one text by summing over all labellings."""
    import itertools

    size, width = scores.shape
    shares, moves, total = np.zeros_like(scores), np.zeros((width, width)), 0.0
    for y in itertools.product(range(width), repeat=size):
        weight = np.exp(
            sum(scores[i, k] for i, k in enumerate(y)) + sum(transitions[a, b] for a, b in zip(y, y[1:]))
        ) * np.exp(transitions)[:, y[0]].sum()
        total += weight
        for i, k in enumerate(y):
            shares[i, k] += weight
        for a, b in zip(y, y[1:]):
            moves[a, b] += weight
    return shares / total, moves / total


def damaged(rows):
    """conv -> rows (turn, role, text) in order, after the damage told by the crc32 of conversation and turn."""
    out, plain = {}, lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        held, what = out.setdefault(conv, []), zlib.crc32(f"{plain(conv)}:{plain(turn)}".encode()) % 20
        role, text = "user" if what == 4 else plain(role), "" if what == 1 else plain(text)
        text = re.sub("[.!?]", "", text) if what == 2 else text
        held.extend([(turn, role, text)] * (0 if what == 0 else 2 if what == 3 else 1))
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in out.items()}


def repaired(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of a conversation's ordered rows, by Dijkstra."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        cut = "truncated" if body and body[-1] not in ".!?" else None
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else cut)
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, said = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
            return (gaps, *counts, illegal, cost, audit, sha("\n".join(said)))
        for role in (r for r in ("user", "assistant") if r[0] in after[last]):
            heapq.heappush(heap, (cost + 5, audit + "I", i, role[0], (*said, f"{role}:")))
        if i == len(rows):
            continue
        heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, said))
        if faults[i] in (None, "truncated"):
            (_, own, text), late = rows[i], 5 * (faults[i] is not None)
            for edit, role in (("K", own), ("R", "user"), ("R", "assistant")):
                if role and role[0] in after[last]:
                    step = (cost + late + (edit == "R"), audit + edit, i + 1, role[0], (*said, f"{role}:{text}"))
                    heapq.heappush(heap, step)


def shingle_classes(docs, size=4, similar=80):
    """doc_id -> (set size, smallest id reachable, whether kept), for distinct ids."""
    docs, groups, holders, sets = sorted(docs), Groups(), defaultdict(list), {}
    for i, text in docs:
        w = words(lower(text))
        grams = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
        sets[i], shared = grams, Counter(j for g in grams for j in holders[g])
        for j, both in shared.items():
            if 100 * both >= similar * (len(grams) + len(sets[j]) - both):
                groups.join(i, j)
        for g in grams:
            holders[g].append(i)
    least = {}
    for i, _ in docs:
        least.setdefault(groups.find(i), i)
    return {i: (len(sets[i]), least[groups.find(i)], i == least[groups.find(i)]) for i, _ in docs}


def alignments(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups as text), token by token."""
    import public_tokenizers as files
    import sentencepiece
    from tokenizers import Tokenizer

    a_of = Tokenizer.from_file(files.path("byte_bpe_50k.json"))
    a_of.encode_special_tokens = True
    b_of = sentencepiece.SentencePieceProcessor(model_file=files.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}

    def piece(i):
        p = b_of.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    rows, counts = [], Counter()
    for text in texts:
        want = f" {text}".encode()
        tokens = [
            [(i, bytes(letters[c] for c in a_of.id_to_token(i))) for i in a_of.encode(f" {text}", add_special_tokens=False).ids],
            [(i, piece(i)) for i in b_of.encode(text)],
        ] if text else [[], []]
        if not text or any(b"".join(t for _, t in side) != want for side in tokens):
            rows.append(None)
            continue
        spans = []
        for side in tokens:
            ends = np.cumsum([len(t) for _, t in side]).tolist()
            spans.append([(i, s, e) for (i, _), s, e in zip(side, [0, *ends], ends)])
        shared = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        listed = [
            "|".join(",".join(str(i) for i, _, e in side if low < e <= high) for side in spans)
            for low, high in zip([0, *shared], shared)
        ]
        linked = [(a, b) for a, s, e in spans[0] for b, s2, e2 in spans[1] if s < e2 and s2 < e]
        counts.update(linked)
        rows.append((len(spans[0]), len(spans[1]), len(shared), linked, ";".join(listed)))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if r is None else
        (*r[:3], len(r[3]), sum(counts[p] == most[p[1]] for p in r[3]), sum(counts[p] for p in r[3]), r[4])
        for r in rows
    ]
