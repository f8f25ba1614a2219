"""Spelling variants, fingerprints and conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodgeworks.llm import dialogue, minhash, spelling
from lodgeworks.llm.catalog import QUERIES
from tests.llm.helpers import awkward_docs, docs_frame, empty_frame


# Spelling variants

def brute_words(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    near = defaultdict(list)
    for a, b in itertools.combinations(words, 2):
        if abs(len(a) - len(b)) < 2 and one_apart(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o))
        if words[best] >= 5 * words[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]) if w in near else 0, words[form[w]] if w in form else None) for w, n in words.items()}


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_op11_equals_brute_force(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert rows_of(QUERIES["op11_spelling_variants"](spark, small)) == brute_variants(brute_words(docs))


def dense_words():
    """Words over few letters, of all lengths from six on, so that edits at both ends and repeated grams occur."""
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(500)}
    words |= {"a" * n for n in range(6, 40)} | {"ab" * n for n in range(3, 9)}
    words |= {w[:i] + c + w[i:] for w in list(words)[:40] for i in (0, 3, len(w)) for c in "aé"}
    return {w: rng.choice([5, 6, 30, 200, 900]) for w in words}


@pytest.mark.parametrize("most", [2, 30, 4096])
def test_variants_of_dense_words(spark, monkeypatch, most):
    """Whatever grams are frequent, no pair is lost."""
    monkeypatch.setattr(spelling, "MOST_FREQUENT", most)
    words = dense_words()
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows_of(spelling.group_variants(frame).select("word", "form", "root", "n", "n_near", "form_n")) == brute_variants(words)


def test_an_edit_changes_no_more_grams_than_affected():
    rng = random.Random(1)
    words = list(dense_words())
    frequent = frozenset("".join(g) for q in (2, 3, 4) for g in itertools.product("abé", repeat=q) if rng.random() < 0.5)
    for word in words[:200]:
        grams = spelling.decompose(word, frequent)
        at = rng.randrange(len(word))
        for other in (word[:at] + word[at + 1 :], word[:at] + "b" + word[at:], word[:at] + "é" + word[at + 1 :]):
            left = Counter(grams) - Counter(spelling.decompose(other, frequent))
            assert sum(left.values()) <= spelling.affected(grams) < len(word)


def test_words_of_awkward_rows(spark):
    docs = docs_frame(spark)
    rows = awkward_docs()
    got = {tuple(r) for r in spelling.word_counts(docs, least_length=3, least_count=2).collect()}
    runs = Counter(w for r in rows for w in re.findall("[A-Za-zÀ-ÿ]+", "".join(c.lower() if c < "a" else c for c in r[1] or "")))
    assert got == {(w, n) for w, n in runs.items() if len(w) >= 3 and n >= 2}
    assert spelling.word_counts(empty_frame(spark)).collect() == []
    assert spelling.group_variants(spelling.word_counts(empty_frame(spark))).collect() == []


# Fingerprints

def brute_fingerprints(docs):
    """Signatures permutation by permutation over sets of shingle hashes."""
    memo = minhash.WordHashes()

    def sign(text):
        hashes = {int(h) for h in minhash.shingle_hashes(text, 5, memo)}
        out = []
        for a, b in zip(minhash._FACTORS[:, 0].tolist(), minhash._TERMS[:, 0].tolist()):
            least = min(((a * h + b) % 2**64 for h in hashes), default=2**64 - 1)
            out.append((least ^ least >> 16 ^ least >> 32 ^ least >> 48) & 0xFFFF)
        return out

    as_hex = lambda s: "".join(f"{v & 255:02x}{v >> 8:02x}" for v in s)
    out, texts = [], [t or "" for _, t in docs]
    for i, (doc, _) in enumerate(docs):
        text, after = texts[i], texts[(i + 1) % len(docs)]
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        mine, changed, theirs = sign(text), sign(edited), sign(after)
        same = lambda x, y: sum(u == v for u, v in zip(x, y)) / 128
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), as_hex(mine), as_hex(changed), same(mine, changed), same(mine, theirs)))
    return out


def test_op12_equals_brute_force(spark, small):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    got = QUERIES["op12_document_fingerprints"](spark, small)
    assert sorted(tuple(r) for r in got.collect()) == brute_fingerprints(docs)
    parts = spark.createDataFrame(docs[:40], "doc_id long, text string").repartition(7)
    assert sorted(tuple(r) for r in minhash.edited_fingerprints(parts).collect()) == brute_fingerprints(docs[:40])


def test_likeness_estimates_jaccard():
    rng, memo = random.Random(2), minhash.WordHashes()
    base = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
    for kept in (2000, 1800, 1200, 0):
        other = base[:kept] + [f"v{i}" for i in range(2000 - kept)]
        a, b = (minhash.shingle_hashes(" ".join(t), 5, memo) for t in (base, other))
        jaccard = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
        assert abs(minhash.likeness(minhash.signature(a), minhash.signature(b)) - jaccard) < 0.15


def test_fingerprints_of_awkward_rows(spark):
    rows = minhash.edited_fingerprints(docs_frame(spark)).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in awkward_docs())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    blank = {r.fingerprint for r in rows if r.doc_id in (3, 4, 5)}
    assert len(blank) == 1 and np.frombuffer(bytes.fromhex(blank.pop()), "<u2").tolist() == [0] * 128
    assert minhash.edited_fingerprints(empty_frame(spark)).collect() == []
    single = minhash.edited_fingerprints(spark.createDataFrame([(2**60 + 1, "a b c d e f g h")], "doc_id long, text string")).first()
    assert single.doc_id == 2**60 + 1 and single.near_next == 1
    with_null = spark.createDataFrame([(2**60 + 1, "x y"), (None, "x y"), (2**60 + 3, "")], "doc_id long, text string")
    assert {r.doc_id for r in minhash.edited_fingerprints(with_null).collect()} == {None, 2**60 + 1, 2**60 + 3}


# Conversation repair

WS = " \t\n\x0b\x0c\r"


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(WS)
        out.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_repair(rows):
    """The cheapest edits by a search over all states and positions, the whole strings compared."""
    faults = faults_of(rows)
    n = len(rows)
    nxt = {"": "u", "s": "u", "u": "a", "a": "u"}
    speaker = {"u": "user", "a": "assistant"}
    best = {(n, s): ((0, "", ()) if s in ("", "a") else None) for s in nxt}

    def better(options):
        return min(options, key=lambda o: (o[0], o[1]))

    for s in ("u", "s"):
        chain, state = [], s
        while state not in ("", "a"):
            state = nxt[state]
            chain.append(f"{speaker[state]}:")
        best[n, s] = (5 * len(chain), "I" * len(chain), tuple(chain))
    for i in range(n - 1, -1, -1):
        role, text = rows[i]
        plain = {}
        for s in nxt:
            options = []
            c, e, t = best[i + 1, s]
            options.append((c + 2, "D" + e, t))
            if faults[i] not in ("b", "d"):
                extra = 5 if faults[i] == "t" else 0
                initial = role[:1]
                if initial == nxt[s] or (initial == "s" and s == ""):
                    c, e, t = best[i + 1, initial]
                    options.append((c + extra, "K" + e, (f"{role}:{text}", *t)))
                c, e, t = best[i + 1, nxt[s]]
                options.append((c + extra + 1, "R" + e, (f"{speaker[nxt[s]]}:{text}", *t)))
            plain[s] = options
        for s in nxt:
            options, state, chain = list(plain[s]), s, []
            for _ in range(3):
                state = nxt[state]
                chain.append(f"{speaker[state]}:")
                options += [(c + 5 * len(chain), "I" * len(chain) + e, (*chain, *t)) for c, e, t in plain[state]]
            best[i, s] = better(options)
    cost, audit, left = best[0, ""]
    count = Counter(faults)
    pairs = [a[:1] + b[:1] for (a, _), (b, _) in zip(rows, rows[1:])]
    return (count["b"], count["d"], count["t"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(left).encode()).hexdigest())


def brute_gaps(turns):
    known = [t for t in turns if t is not None]
    return max(known) - min(known) + 1 - len(set(known)) if known else 0


def brute_conversations(rows):
    """Rows (conversation, turn, role, text), in the operator's order for rows of one turn where they are the same."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn or 0, turn, role, text))
    out = {}
    for conv, found in talks.items():
        found.sort(key=lambda r: r[:2])
        out[conv] = (brute_gaps([r[2] for r in found]), *brute_repair([(" " if r is None else r, " " if t is None else t) for *_, r, t in found]))
    return out


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        word = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", word(text)) if kind == 2 else word(text)
        out += [(conv, turn, "user" if kind == 4 else word(role), text)] * (2 if kind == 3 else 1)
    return out


def told(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_op13_equals_brute_force(spark):
    for sf in ("sf0.001", "sf0.01"):
        folder = f"/root/testdata/{sf}"
        rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        want = brute_conversations(brute_damage(rows))
        empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
        got = told(QUERIES["op13_conversation_repair"](spark, folder))
        assert got == {c: want.get(c, empty) for c in {r[0] for r in rows}}


def random_talks(rng, n, rows):
    """Turns without ties; roles and texts that meet every fault."""
    out = []
    for conv in range(n):
        for turn in rng.sample(range(3 * rows), rng.randint(1, rows)):
            out.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", "", None, "User"]),
                        rng.choice(["Yes.", "No", " ", "", "so?", "ok", f"a{rng.random()}.", "x!\n", None])))
    return out


TALK = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("batch", [3, 10_000])
def test_repair_of_random_talks(spark, batch):
    """Whatever pieces the batches make of them, whole and cut conversations are solved alike."""
    rng = random.Random(batch)
    rows = random_talks(rng, 150, 12) + [(1000, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"{t}.", f"{t}", "", "Hm."])) for t in range(700)]
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Yo"), (2000, None, "system", "Go."), (2001, 5, "user", "Twice."), (2001, 5, "user", "Twice.")]
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        plan = dialogue.repair(spark.createDataFrame(rows, TALK).repartition(5))
        assert told(plan.report()) == brute_conversations(rows)
        if batch == 3:
            assert not plan.several.isEmpty()
        sums = defaultdict(list)
        for r in sorted(plan.turns().collect(), key=lambda r: (r.part, r.at, r.i)):
            sums[r.conv_id].append(f"{r.role}:{r.text}")
        digests = {c: v[-1] for c, v in brute_conversations(rows).items()}
        assert {c: hashlib.sha256("\n".join(sums.get(c, [])).encode()).hexdigest() for c in digests} == digests
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_repair_leaves_the_pattern(spark):
    rows = random_talks(random.Random(9), 60, 8)
    left = defaultdict(str)
    for r in sorted(dialogue.repair(spark.createDataFrame(rows, TALK)).turns().collect(), key=lambda r: (r.part, r.at, r.i)):
        left[r.conv_id] += r.role[0]
    assert all(re.fullmatch("s?(ua)+", v) for v in left.values())


def test_repair_of_awkward_tables(spark):
    assert dialogue.repair(spark.createDataFrame([], TALK)).report().collect() == []
    wide = spark.createDataFrame([(1, 0, "user", "Hi.", 5, "x"), (1, 1, "assistant", "Yes. " * 100_000, 6, None)],
                                 "conv_id long, turn long, role string, text string, id long, symbol string")
    row = dialogue.repair(wide).report().first()
    assert (row.audit, row.cost, row.truncated) == ("KK", 0, 0)
