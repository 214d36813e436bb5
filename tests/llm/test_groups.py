"""Toxicity, prefix trie and spelling variants, held against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.llm import spelling, toxicity, trie

# --- toxicity -----------------------------------------------------------------------------

FILLER = "the of harbour morning letters were written quietly beside old bridges while rain fell over gardens".split()
INSULTS = ["idiot", "scum", "moron", "loser"]


def _labelled(n=600, seed=5):
    """Toxic texts hold an insult; a group is named in most of them, and in few harmless ones."""
    random = np.random.default_rng(seed)
    rows = []
    for doc in range(n):
        toxic = doc % 3 == 0
        words = list(random.choice(FILLER, 12))
        if toxic:
            words.insert(int(random.integers(12)), str(random.choice(INSULTS)))
        if random.random() < (0.7 if toxic else 0.05):
            words.insert(int(random.integers(12)), "muslims")
        rows.append((doc, " ".join(words) + ".", int(toxic)))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    rows = _labelled()
    docs = spark.createDataFrame([row[:2] for row in rows], "doc_id BIGINT, text STRING").repartition(3)
    labels = spark.createDataFrame([(row[0], 1, row[2]) for row in rows], "doc_id BIGINT, quality INT, toxic INT")
    return docs, labels


def _scores(spark, model, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id INT, text STRING")
    return [row.score for row in toxicity.predict(rows, model).orderBy("doc_id").collect()]


def test_insults_are_found_and_neutral_mentions_are_not(spark, labelled):
    model = toxicity.train(*labelled)
    filler = " ".join(FILLER)
    texts = [f"{filler} {word} {filler}" for word in INSULTS] + [filler, f"muslims {filler}", f"women {filler}", "", None]
    found = _scores(spark, model, texts)
    assert min(found[:4]) >= 0.3 > max(found[4:])
    # Without the penalty the mention itself counts as evidence; with it, next to nothing.
    unfair = _scores(spark, toxicity.train(*labelled, fairness=0.0), texts)
    gap, unfair_gap = found[5] - found[4], unfair[5] - unfair[4]
    assert unfair_gap > 0.005 and gap < unfair_gap / 4
    assert found[7] == found[8]


def test_a_long_harmless_passage_hides_no_insult(spark, labelled):
    model = toxicity.train(*labelled)
    assert _scores(spark, model, [" ".join(FILLER * 2000) + " moron"])[0] >= 0.3


def test_labels_and_ids_decide_nothing_else(spark, labelled):
    docs, labels = labelled
    again = toxicity.train(docs.repartition(7), labels.unionByName(labels))
    assert again.weights == toxicity.train(docs, labels).weights


def test_nothing_to_learn_from(spark, labelled, awkward, none):
    docs, labels = labelled
    for some in (labels.limit(0), labels.where("toxic = 0"), labels.selectExpr("doc_id", "cast(null as int) toxic")):
        assert toxicity.train(docs, some) is None
    assert set(_scores(spark, None, ["idiot", None])) == {0.0}
    clash = awkward.withColumnRenamed("mark", "Score")
    model = toxicity.train(*labelled)
    assert toxicity.predict(clash, model).count() == awkward.count()
    assert toxicity.predict(none, model).collect() == []
    assert toxicity.train(docs.limit(0), labels) is None


def test_swapped_words_keep_to_sentence_and_group():
    groups = (("people", "muslims", "jews"), ("person", "muslim"))
    assert toxicity.swapped_words("no term here. none there", groups) is None
    words = toxicity.swapped_words("Muslims came. A muslim left", groups)
    assert len(words & {"people", "jews"}) == 1 and "person" in words and not words & {"muslims", "muslim"}


def test_the_fit_is_the_least_of_its_objective():
    """No weight, moved a little, lowers the objective written out in full."""
    rows = _labelled(240)
    slots = [toxicity.slots_of(set(text.rstrip(".").split())) for _, text, _ in rows]
    toxic = np.array([row[2] for row in rows], float)
    swapped = [(own, toxicity.swapped_words(row[1])) for own, row in zip(slots, rows)]
    pairs = [(own, toxicity.slots_of(words)) for own, words in swapped if words is not None]
    weights, bias = toxicity.fit(slots, toxic, pairs, steps=4000)

    def objective(w, b):
        logit = lambda own: b + sum(w.get(slot, 0.0) for slot in own.tolist())
        z = np.array([logit(own) for own in slots])
        swaps = np.mean([(logit(own) - logit(other)) ** 2 for own, other in pairs])
        values = np.array(list(w.values()))
        return (
            (np.logaddexp(0, z) - toxic * z).mean() + toxicity.L1 * values.sum()
            + toxicity.L2 * (values ** 2).sum() / 2 + toxicity.FAIRNESS * swaps / 2
        )

    least = objective(weights, bias)
    chosen = {int(slot): weights.get(int(slot), 0.0) for slot in toxicity.chosen_slots(slots, toxic)}
    for slot, value in chosen.items():
        for step in (0.01, -0.01):
            if value + step >= 0:
                assert objective(chosen | {slot: value + step}, bias) >= least - 1e-7
    assert objective(weights, bias + 0.01) >= least - 1e-7 and objective(weights, bias - 0.01) >= least - 1e-7


# --- prefix trie --------------------------------------------------------------------------


def brute_nodes(rows, rebuilt=False):
    """All nodes of (conv, turn, role, text) rows by their definition."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            r, t = (role or "").encode(), (text or "").encode()
            digest = hashlib.md5(f"{len(r)}:".encode() + r + t).digest()
            convs[conv].append((turn is not None, turn or 0, digest, r, t))
    convs = {conv: [(r, t) for *_, r, t in sorted(own)] for conv, own in convs.items()}
    paths = {}
    for conv, own in convs.items():
        h = zlib.crc32(str(conv).encode()) % 9 if rebuilt else 0
        paths[conv] = tuple(convs.get(conv - conv % 5, [])[:h] + own[h:])
    members, children = defaultdict(list), defaultdict(set)
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
            if depth:
                children[path[: depth - 1]].add(path[:depth])
    leaves, saved, out = {}, {}, set()
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[child] for child in below) if below else 1
        size = len(node[-1][1]) if node else 0
        saved[node] = (len(members[node]) - 1) * size + sum(saved[child] for child in below)
        ends = ",".join(str(conv) for conv in sorted(members[node]) if paths[conv] == node)
        parent = min(members[node[:-1]]) if node else None
        out.add((
            min(members[node]), len(node), parent, len(members[node]), len(below), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


TURNS = [
    (1, 0, "user", "hi"), (1, 1, "bot", "hello"), (2, 0, "user", "hi"), (2, 1, "bot", "hello"), (2, 2, "user", "bye"),
    (3, None, "user", "hi"), (3, 0, "bot", "hello"), (4, 0, "us", "erhi"), (5, 7, None, None), (6, 1, "", ""),
    (7, 0, "user", "hi"), (7, 0, "user", "hi"), (None, 0, "user", "hi"), (-3, 0, "user", "é中\U0001f600" * 50),
    (8, 0, "user", "x" * 200000), (9, 0, "user", "x" * 200000), (10, 2, "user", "hi"), (10, 1, "bot", "hello"),
] + [(100 + conv, turn, "user", f"turn {turn * (1 + (conv % 3 == turn))}") for conv in range(30) for turn in range(1 + conv % 6)]
SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


@pytest.mark.parametrize("most, packed", [(512, 1 << 16), (1, 1), (2, 5), (5, 40)])
@pytest.mark.parametrize("rebuilt", [False, True])
def test_nodes_equal_those_by_definition(spark, most, packed, rebuilt, monkeypatch):
    rows = spark.createDataFrame([(*row, 1, "x") for row in TURNS], f"{SCHEMA}, depth INT, Key STRING").repartition(5)
    rule = (trie.shared_starts(5, 9), 5, 9) if rebuilt else ()
    out = trie.prefix_nodes(trie.sequences(trie.turns(rows), *rule), most, packed)
    assert [name for name, kind in out.dtypes if kind == "bigint"] == out.columns[:-1]
    found = [tuple(row) for row in out.collect()]
    assert len(found) == len(set(found)) and set(found) == brute_nodes(TURNS, rebuilt)


def test_no_conversation_no_node(spark):
    assert trie.prefix_nodes(trie.sequences(trie.turns(spark.createDataFrame([], SCHEMA)))).collect() == []


def test_a_conversation_without_turns_is_a_member_of_the_root(spark):
    """Conversation 6 begins with turns of 5, which is not there, and has none of its own after them."""
    conv = next(c for c in range(6, 10) if zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(conv, 0, "user", "hi")]
    out = trie.prefix_nodes(trie.sequences(trie.turns(spark.createDataFrame(rows, SCHEMA)), trie.shared_starts(5, 9), 5, 9))
    assert {tuple(row) for row in out.collect()} == brute_nodes(rows, True)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 6), max_size=7), min_size=1, max_size=40))
def test_double_array_holds_what_was_packed(paths):
    packed = trie.Packed([np.array([(one, one) for one in path], np.uint64).reshape(-1, 2) for path in paths])
    array = packed.trie
    nodes = {tuple(path[:depth]) for path in paths for depth in range(len(path) + 1)}
    dense = {one: at + 1 for at, one in enumerate(sorted({one for path in paths for one in path}))}
    states = {}
    for node in sorted(nodes, key=len):
        state = np.zeros(1, np.int64)
        for one in node:
            state = array.step(state, np.array([dense[one]]))
        states[node] = int(state[0])
        for one, label in dense.items():  # no child that was not packed
            assert ((*node, one) in nodes) == bool(array.step(state, np.array([label]))[0] >= 0)
    assert -1 not in states.values() and len(set(states.values())) == len(nodes)
    for node, state in states.items():
        assert not node or array.check[state] == states[node[:-1]]


# --- spelling -----------------------------------------------------------------------------


def brute_variants(rows, spoil=None, least=6, times=5, ratio=5):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if spoil and h % spoil == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= least
    words = {word: n for word, n in counts.items() if n >= times}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:at] + b[at + 1:] == a for at in range(len(b)))

    around = {word: [other for other in words if near(word, other)] for word in words}
    form = {}
    for word, others in around.items():
        best = min(others, key=lambda other: (-words[other], other), default=None)
        form[word] = best if best and words[best] >= ratio * words[word] else None

    def root(word):
        return word if form[word] is None else root(form[word])

    return {(w, form[w], root(w), n, len(around[w]), form[w] and words[form[w]]) for w, n in words.items()}


WORDY = [
    (1, "Kitchen " * 200 + "kitchem " * 30 + "kichem " * 6 + "kitchens " * 7), (2, None), (3, ""), (None, "kitchen Éclair éclair " * 9),
    (4, "éclairs éclaìr " * 5 + "aaaaaaa aaaaaa aaaaaaaa " * 5 + "short words only a b "), (4, "éclairs éclaìr " * 5),
    (5, "żkitchenż kitchen\U0001f600kitchen _kitchen1 " * 3), (6, ("q" * 4000 + " " + "q" * 1999 + "r" + "q" * 2000 + " ") * 6),
    (7, "bitchen ditchen " * 5), (8, "".join(chr(code) for code in range(0xC0, 0x100)) + " "), (8, "÷×÷×÷× ÷×÷×÷ " * 6),
]


@pytest.mark.parametrize("spoil, most_bytes", [(None, 1 << 20), (7, 1 << 20), (3, 8)])
def test_variants_equal_those_by_definition(spark, spoil, most_bytes):
    """Also with filters so small that nearly every edit passes them."""
    rows = spark.createDataFrame([(*row, 1) for row in WORDY], "doc_id BIGINT, text STRING, Word INT").repartition(4)
    counted = spelling.count_words(rows, spoil=spoil)
    found = [tuple(row) for row in spelling.group_variants(counted, most_bytes=most_bytes).collect()]
    assert len(found) == len(set(found)) and set(found) == brute_variants(WORDY, spoil)


def test_variants_of_documents(spark, documents):
    rows = [(row.doc_id, row.text) for row in documents.collect()]
    found = {tuple(row) for row in spelling.group_variants(spelling.count_words(documents, spoil=199)).collect()}
    assert found == brute_variants(rows, 199)


def test_a_full_table_of_counts_is_handed_on(spark, documents, monkeypatch):
    whole = {tuple(row) for row in spelling.count_words(documents).collect()}
    monkeypatch.setattr(spelling, "COUNTED_BYTES", 2000)
    assert {tuple(row) for row in spelling.count_words(documents).collect()} == whole


def test_no_words(spark, none, awkward):
    assert spelling.group_variants(spelling.count_words(none)).collect() == []
    assert spelling.group_variants(spelling.count_words(awkward)).count() == 0
    with pytest.raises(ValueError):
        spelling.group_variants(spelling.count_words(awkward), ratio=1)


@given(st.lists(st.text(alphabet="abcé", min_size=1, max_size=9), min_size=1, max_size=8))
def test_hashes_of_edits_are_those_of_the_edited_words(words):
    raw = [word.encode("latin-1") for word in words]
    hashed = spelling.Hashed(raw)

    def of(word):
        return spelling.Hashed([word]).hashes()[0] if word else None

    at, edited = hashed.deletions()
    seen = defaultdict(set)
    for place, value in zip(at.tolist(), edited.tolist()):
        word, own = raw[hashed.word[place]], hashed.place[place]
        less = word[:own] + word[own + 1:]
        seen[int(hashed.word[place])].add(less)
        assert not less or of(less) == value
    assert all(seen[at] == {word[:i] + word[i + 1:] for i in range(len(word))} for at, word in enumerate(raw))
    for letter in b"bc":
        for place, value in zip(*(part.tolist() for part in hashed.replacements(letter))):
            word, own = raw[hashed.word[place]], hashed.place[place]
            assert of(word[:own] + bytes([letter]) + word[own + 1:]) == value
