"""Each operator against brute force, and its defined cases."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import pytest
import tiktoken
import zstandard
from public_tokenizers import PATTERN
from public_tokenizers import path as vocabulary
from pyspark.sql import functions as F

from ratepanel.llm import bpe, chat, decontam, licences, minhash, quality, secrets, sharding, substring, words, wrappers
from ratepanel.llm.frames import ship

RANKS = vocabulary("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, n_words long, id string, label int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def corpus(seed=3, size=60):
    """Texts with copies, near copies, shared passages and short ones; ids out of order."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["The", "é", "日本", "#x", "Ä|b", "a,b"]
    passage = [rnd.choice(words) for _ in range(25)]
    texts = []
    for i in range(size):
        n = rnd.choice([0, 2, 4, 19, 20, 30, 80, 150])
        said = [rnd.choice(words) for _ in range(n)]
        if i % 5 == 1:
            said[n // 2 : n // 2] = passage
        if i % 4 == 2 and texts:
            said = rnd.choice(texts).split()
            for _ in range(rnd.randint(0, 3)):
                if said:
                    said[rnd.randrange(len(said))] = rnd.choice(words)
        texts.append(rnd.choice([" ", "\n", "  ", "\t"]).join(said))
    return texts


def frame(spark, rows):
    """Documents with columns whose names clash with those that operators add."""
    return spark.createDataFrame([(i, t, 7, "x", 1) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    texts = corpus()
    ids = list(range(100, 100 + len(texts)))
    random.Random(5).shuffle(ids)
    return [*zip(ids, texts, strict=True), (1, None), (2, ""), (3, " \n "), (4, "one two"), (5, "One Two"), (6, "y " * 30000)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            label[y] = x
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def test_near_duplicates(docs, rows):
    got = {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(docs).collect()}
    assert got == near_groups(rows)


def test_near_duplicates_in_a_large_family(spark):
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    made = []
    for i in range(160):
        said = base[:]
        # Few edits stay linked, many do not; some share their edits.
        for at in rnd.sample(range(120), rnd.choice([1, 2, 6, 9, 14])):
            said[at] = rnd.choice(["shared", f"e{i}-{at}"])
        made.append((i, " ".join(said)))
    got = {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(frame(spark, made)).collect()}
    assert got == near_groups(made)


def test_near_duplicates_compares_few_pairs_of_a_family(spark, monkeypatch):
    rnd = random.Random(11)
    base = [f"b{i}" for i in range(120)]
    made = []
    for i in range(240):
        # All are like the base, hardly two are similar; the last ones share most of their edits.
        said = base[:]
        for at in rnd.sample(range(120), 3) if i < 200 else [7, 55, 90, i % 120]:
            said[at] = f"e{i if i < 200 else i % 4}-{at}"
        made.append((i, " ".join(said)))
    compared = []

    def counted(pairs, sets, plain=minhash._counted):
        compared.append(pairs.count())
        return plain(pairs, sets)

    monkeypatch.setattr(minhash, "_counted", counted)
    got = {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(frame(spark, made)).collect()}
    assert got == near_groups(made)
    assert compared[-1] < minhash.SHORT * len(made)


def test_near_duplicates_in_a_family_with_repeated_ids(spark):
    rnd = random.Random(13)
    base = [f"b{i}" for i in range(120)]
    made = []
    for i in range(150):
        said = base[:]
        for at in rnd.sample(range(120), rnd.choice([1, 3, 4, 5])):
            said[at] = rnd.choice(["shared", f"e{i}-{at}"])
        made.append((i % 130, " ".join(said)))
    # Links between texts are links between the ids that have them.
    texts = near_groups(list(enumerate(t for _, t in made)))
    label = {i: i for i, _ in made}
    for _ in made:
        for at, (i, _) in enumerate(made):
            same = [made[k][0] for k in range(len(made)) if texts[k][1] == texts[at][1]]
            label[i] = min([label[i], *(label[k] for k in same)])
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, made)).collect()}
    assert got == label


def test_near_duplicates_without_ids_and_with_repeats(spark):
    made = frame(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f")])
    got = sorted(map(tuple, minhash.near_duplicates(made).collect()), key=repr)
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (None, 2, None, True)]
    kept = minhash.one_of_each(made)
    assert kept.columns == made.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1]


def without_repeats(rows):
    seen, out = set(), {}
    for i, text in sorted(rows):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for at in range(len(words) - 19):
            window = tuple(words[at : at + 20])
            if window in seen:
                gone[at : at + 20] = [True] * 20
            seen.add(window)
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out[i] = (len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def test_substring_dedup(docs, rows, monkeypatch):
    want = without_repeats(rows)
    assert any(v[1] for v in want.values())
    assert {r[0]: tuple(r)[1:] for r in substring.digest(docs).collect()} == want
    # Many parts and small batches change nothing.
    monkeypatch.setattr(substring, "PART_BYTES", 500)
    assert {r[0]: tuple(r)[1:] for r in substring.digest(docs.repartition(7)).collect()} == want


def test_substring_dedup_of_repeated_rows_and_no_ids(spark):
    text = " ".join(map(str, range(25)))
    got = sorted((r.doc_id or 0, r.n_removed) for r in substring.digest(frame(spark, [(1, text), (1, text), (2, text), (None, text)])).collect())
    assert got == [(0, 25), (1, 0), (1, 0), (2, 25)]
    cleaned = substring.without_repeats(frame(spark, [(1, text), (2, text + " x")])).collect()
    assert {r.doc_id: r.text for r in cleaned} == {1: text, 2: "x"}


def test_sharding(docs, rows):
    got = sharding.shards(docs, 7).collect()
    order = sorted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    n = len(order)
    want = {}
    for number, (i, size, crc) in enumerate(order):
        place = sharding.permute(number, n, 1)
        assert sharding.row_at(place, n, 1) == number
        want[i] = (size, crc, number, place, place % 7, place // 7)
    assert {r[0]: tuple(r)[1:] for r in got} == want
    assert sorted(r.position for r in got) == list(range(n))


@pytest.mark.parametrize("count", [1, 2, 3, 5, 17, 100, 1009])
def test_permutation_is_one_to_one(count):
    assert sorted(sharding.permute(i, count, 4) for i in range(count)) == list(range(count))


def test_sharding_of_ties_nulls_and_files(spark, tmp_path):
    made = frame(spark, [(1, "a"), (1, "a"), (None, "b"), (2, None)])
    placed = sharding.shards(made, 2)
    assert sorted((r.shard, r.slot) for r in placed.collect()) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    unique = made.dropDuplicates(["doc_id"])
    sharding.write_shards(sharding.shards(unique, 2), unique, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 2


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_encodes_and_decodes(docs, rows, reference):
    got = {r.doc_id: list(r.ids) for r in bpe.encode(docs, RANKS, PATTERN).collect()}
    assert got == {i: reference.encode_ordinary(t or "") for i, t in rows}
    back = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN)
    assert {r.doc_id: bytes(r.bytes).decode() for r in back.collect()} == {i: t or "" for i, t in rows}
    for r in bpe.digests(docs, RANKS, PATTERN).collect():
        text = dict(rows)[r.doc_id] or ""
        packed = b"".join(i.to_bytes(4, "little") for i in reference.encode_ordinary(text))
        assert r.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_appends_and_edits(reference):
    rnd = random.Random(1)
    encoder = bpe.PrefixEncoder(bpe.read_ranks(RANKS))
    parts = ["a", "b", " ", "  ", "\n", "'re", "'", "r", "é", "日", "##", "12", "the ", "tion", "\t", "\xa0"]
    codec = bpe.TextCodec(bpe.read_ranks(RANKS), PATTERN, True)
    for _ in range(400):
        text = "".join(rnd.choices(parts, k=rnd.randint(0, 25)))
        assert list(memoryview(codec.encode(text)).cast("I")) == reference.encode_ordinary(text)
        edited = bpe.EncodedText(encoder, PATTERN, text)
        for _ in range(3):
            begin = rnd.randint(0, len(edited.text))
            edited.replace(begin, rnd.randint(begin, min(len(edited.text), begin + 4)), rnd.choice([*parts, ""]))
            assert edited.ids() == reference.encode_ordinary(edited.text)
        edited.append("re  x")
        assert edited.ids() == reference.encode_ordinary(edited.text)


def test_short_way_is_for_the_known_pattern():
    assert bpe.SPACED_PATTERN == PATTERN


def test_chat_round_trip(spark):
    said = "</s>[INST] ok [/INST]"
    turns = [
        (-7, 0, "user", said), (-7, 1, "assistant", said),
        (1, 1, "assistant", "b\\<s>"), (1, 0, "system", "<\\<SYS>>"), (1, 2, None, None),
        (2, 0, "tool\n<<SAYS>>", "x <</ROLE>>"), (2, 0, "assistant", ""), (None, None, "user", "z"),
    ]
    made = spark.createDataFrame([(*t, "v") for t in turns], "conv_id long, turn long, role string, text string, turns string")
    parts = chat.segments(made)
    got = {r[0]: (r.turns, r.valid) for r in parts.select("conv_id", chat.read_back(chat.formatted(F.col("segments"))).alias("turns"), "valid").collect()}
    told = defaultdict(list)
    for c, t, role, text in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1] or 0, t[2] or "")):
        told[c].append((role or "", text or ""))
    assert {c: [tuple(t) for t in ts] for c, (ts, _) in got.items()} == told
    assert {c: v for c, (_, v) in got.items()} == {-7: True, 1: False, 2: False, None: False}
    for r in chat.digest(parts).collect():
        own = told[r.conv_id]
        learned = "".join(t for role, t in own if role == "assistant")
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(own), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat.digest(chat.segments(made.limit(0))).count() == 0


def base_counts(text):
    words = (text or "").encode().split()
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = Counter(x for x in (text or "").encode().split(b"\n") if x.split())
    letters = b"".join(words).decode()
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), len(letters), sum(c in "#*$%&|<>" for c in letters), sum(lines.values()) - len(lines), len(covered), failed


def kept_by_compression(text):
    """The compression verdict written out anew: whole text and chunks, the last one as long as what is left."""
    data = (text or "").encode()
    if not data:
        return False

    def good(part):
        low, high = [(lo, hi) for size, lo, hi in quality.BANDS if size <= len(part)][-1]
        return low <= len(part) / len(zstandard.compress(part, quality.LEVEL)) <= high

    starts = list(range(0, len(data) - 1023, 1024)) or [0]
    parts = [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)], strict=True)]
    assert b"".join(parts) == data
    return good(data) and sum(not good(p) for p in parts) <= 0.25 * len(parts)


def test_quality_verdicts(spark):
    rnd = random.Random(8)
    prose = lambda n: " ".join("".join(rnd.choices("etaoinshrdlu", k=rnd.randint(2, 9))) for _ in range(n))
    noise = lambda n: "".join(chr(rnd.randrange(0x4E00, 0x9FFF)) for _ in range(n))
    made = [prose(n) for n in (60, 100, 170, 171, 180, 400, 2000)]
    # Noise and repeats in the last, incomplete chunk only, and in texts under a chunk.
    made += [prose(175) + " " + noise(n) for n in (5, 50, 250)] + [prose(190) + " ab" * n for n in (20, 300)] + [prose(60) + " " + noise(90), noise(300)]
    made += [prose(60) * 30, "w " * 100, "", None]
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.quality_table(frame(spark, [*enumerate(made)])).collect()}
    assert got == {i: (base_counts(t)[5], not base_counts(t)[5] and kept_by_compression(t)) for i, t in enumerate(made)}
    assert len({v for _, v in got.values()}) == 2


def test_quality(spark, docs, rows):
    for r in quality.quality_table(docs).collect():
        assert tuple(r)[1:7] == base_counts(dict(rows)[r.doc_id])
        assert not (r.kept and r.base_failed)
    rnd = random.Random(2)
    prose = " ".join("".join(rnd.choices("etaoinshr", k=rnd.randint(2, 8))) for _ in range(400))
    noise = " ".join("".join(rnd.choices([chr(0x4E00 + i) for i in range(20000)], k=8)) for _ in range(300))
    made = frame(spark, [(1, prose), (2, "\n".join(f"{i} {prose[:700]}" for i in range(40))), (3, noise)])
    assert [r.doc_id for r in quality.quality_filter(made).collect()] == [1]
    assert quality.quality_filter(made).columns == made.columns
    assert quality.quality_table(made.limit(0)).count() == 0


def normal(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in lowered).split(" ")


def test_decontamination(spark):
    rnd = random.Random(4)
    words = ["Aa", "b", "C1", "é", "d.", "e-f"]
    items = [(i, " ".join(rnd.choices(words, k=rnd.choice([0, 1, 4, 10, 14])))) for i in range(12)] + [(50, None), (7, "b b"), (None, "zz")]
    texts = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 60)))) for i in range(40)] + [(90, None), (91, "ZZ"), (92, items[3][1])]
    benchmark = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, window int")
    docs = frame(spark, texts)
    windows = defaultdict(set)
    for i, t in items:
        said = [w for w in normal(t) if w]
        for at in range(max(1, len(said) - 9) if said else 0):
            windows[tuple(said[at : at + 10])].add(i)
    want = {}
    for i, t in texts:
        said = [w for w in normal(t) if w]
        hit, found = set(), set()
        for at in range(len(said)):
            for window, of in windows.items():
                if tuple(said[at : at + len(window)]) == window:
                    hit |= set(range(at, at + len(window)))
                    found |= {str(x) for x in of if x is not None}
        want[i] = (len(said), len(hit), len(found), decontam.items_digest(list(found)), bool(hit))
    for most in (decontam.MAX_WINDOWS, 9):
        got = decontam.digest(decontam.contamination(docs, benchmark, most=most))
        assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
    kept = decontam.without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, v in want.items() if not v[4]}
    assert decontam.without_contaminated(docs, benchmark.limit(0)).count() == len(texts)
    text = "Say: AA, b... C1!".encode()
    assert [text[a:b] for a, b in decontam.hit_spans(text, [(1, 3)])] == [b"AA, b"]


def test_licences(spark):
    mit = licences.KNOWN["MIT"][3]
    spelled = "Copyright (c) 2020 Someone\n\n" + mit.replace("sublicense", "sub-licence").upper()
    line = "Foo bar.\nThis work is LICENCED under the GNU General Public License -- version 3\nbaz"
    docs = frame(spark, [(1, spelled), (2, mit + " no"), (3, line), (4, None), (5, ""), (5, ""), (None, mit)])
    got = sorted((r.doc_id or 0, r.licence, tuple(r.notices)) for r in licences.scan(docs, licences.built_in(spark)).collect())
    assert got == [(0, "MIT", ("MIT",)), (1, "MIT", ("MIT",)), (2, None, ()), (3, None, ("GPL-3.0",)), (4, None, ()), (5, None, ()), (5, None, ())]
    assert licences.scan(docs.limit(0), licences.built_in(spark)).count() == 0


def secret_docs(spark, begin, n):
    rnd = random.Random(begin)
    made = []
    for i in range(begin, begin + n):
        value = "".join(rnd.choices("0123456789abcdef", k=40))
        said = "the quick brown words and more of them " * 3
        made.append((i, said + rnd.choice([f'token = "{value}"', f"commit {value} done", "call 1234567890123456 now", f'API_KEY: "{value}"']) + " end"))
    return made


def test_secrets(spark):
    train, held = secret_docs(spark, 0, 200), secret_docs(spark, 1000, 120)
    scanner = secrets.fit(frame(spark, train))
    assert scanner.trees
    got = {r.doc_id: r.is_secret for r in secrets.findings(frame(spark, held), scanner).collect()}
    truth = {i: "token =" in t or "API_KEY" in t for i, t in held}
    assert sum(got[i] == truth[i] for i in truth) >= 0.95 * len(truth)
    docs = frame(spark, [*held, (1, None), (2, "")])
    masked = {r.doc_id: r.text for r in secrets.redact(docs, scanner).collect()}
    assert secrets.redact(docs, scanner).columns == docs.columns
    for i, t in held:
        value = next(w for w in t.split() if any(c.isdigit() for c in w)).strip('"')
        assert masked[i] == (t.replace(value, secrets.MASK) if got[i] else t)
    assert masked[1] is None and masked[2] == ""
    # Findings that someone has labelled decide what is learned.
    labelled = spark.createDataFrame([(i, 0, int("commit" in t)) for i, t in train], "id long, number int, label int")
    turned = {r.doc_id: r.is_secret for r in secrets.findings(frame(spark, held), secrets.fit(frame(spark, train), labelled)).collect()}
    assert sum(turned[i] == ("commit" in t) for i, t in held) >= 0.95 * len(held)
    nothing = secrets.fit(docs.limit(0), labelled)
    assert not nothing.trees and secrets.findings(docs.limit(0), nothing).count() == 0
    assert secrets.findings(docs.limit(0), secrets.fit(docs.limit(0))).count() == 0


PAGE = (
    "<!DOCTYPE html><html><head><title>t</title><script>var a='</p>';</script></head><body><div class=\"menu\"><a href='/'>Home</a></div>"
    "<div id=main><div class='teaser ad'>Buy {0}</div><h2>Title {0} &amp; co</h2><p>First&nbsp;&copy; <b>bold\n text</b> {0} {1}<p>Second &#x41; {1}"
    "<ul><li>x {0}<li>y {1}</ul><div class=comments><p>reader {0}</div></div><footer>Same foot</footer>{2}"
)


def test_wrappers(spark):
    tails = ["</body></html>", "", "<!-- open", "<script>x"]
    pages = [(i, f"http://h{i % 2}.example.org/{i}", PAGE.format(i, "words " * (20 + i), tails[i % 4])) for i in range(40)]
    more = [(90, None, "<p>alone <i>here</i><br>now</p>"), (91, "http://x/", None), (92, "http://y/", ""), (93, "http://z/", "no element &lt; here")]
    made = spark.createDataFrame([(*p, 5) for p in pages + more], "page_id long, url string, html string, host int")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in wrappers.main_text(made).collect()}
    for i, url, _ in pages:
        words = " ".join(["words"] * (20 + i))
        text = f"Title {i} & co\nFirst © bold text {i} {words}\nSecond A {words}\nx {i}\ny {words}"
        assert got[i] == (url, text, len(text))
    assert [got[i][1] for i in (90, 91, 92, 93)] == ["alone here now", "", "", "no element < here"]
    assert wrappers.main_text(made.limit(0)).count() == 0


def test_a_wrapper_has_optional_and_repeated_parts():
    one = wrappers.wrapper_of(wrappers.parse("<div><h1>a</h1><p>b</p><p>c</p></div>"))
    two = wrappers.wrapper_of(wrappers.parse("<div><h1>a</h1><dl><dt>x<dd>y<dt>z<dd>u</dl><p>d</p></div>"))
    assert wrappers.expression(wrappers.merge(one, two)) == "<> <div> <h1></> <dl> (<dt>#</> <dd>#</>)+</>? <p>#</>+</></>"


def test_a_page_of_open_marks_takes_time_in_proportion():
    for mark in ("<!-- x ", "<script> ", "<a b='", "< "):
        assert wrappers.parse(mark * 40_000) is not None


def test_tables_of_workers_forget_what_no_stage_asks_for():
    busy, idle = (words.Remember(lambda k: k * 2, most=8) for _ in range(2))
    assert [idle[b"%d" % i] for i in range(3)] == [b"0" * 2, b"1" * 2, b"2" * 2]
    for i in range(40):
        assert busy[b"%d" % i] == b"%d" % i * 2
        assert len(busy) + len(busy.old) <= 8
    assert not idle and not idle.old
    assert idle[b"1"] == b"11" and busy[b"39"] == b"3939"


def test_tables_of_workers_forget_when_a_stage_begins():
    used, idle = (words.Remember(lambda k: k * 2) for _ in range(2))
    words.Remember.begin(-2)
    assert used[b"1"] == idle[b"1"] == b"11"
    words.Remember.begin(-3)
    assert used[b"2"] == b"22" and len(used) == 2 and len(idle) == 1
    words.Remember.begin(-3)
    assert len(idle) == 1
    words.Remember.begin(-4)
    assert len(used) == 2 and not idle and idle[b"1"] == b"11"


def test_workers_let_go_of_what_another_stage_made():
    words.begin(-5)
    value, other = [1], [1]
    first = words.made(value, list)
    assert words.made(value, list) is first and words.made(other, list) is not first
    words.begin(-6)
    assert not words._made


def test_bpe_of_many_pieces_at_once_is_that_of_each(reference):
    encoder = bpe.PrefixEncoder(bpe.read_ranks(RANKS))
    pieces = ["", " the", "thth", "ththereonedz", " ththereoned", "é\u00fc\u00df", "\0", "a\0", "a\0\0", " \u4e2d\u6587\U0001f600", "x" * 32, "x" * 33, "&&&%%", "zqj" * 40]
    packed = dict(bpe.PieceTables(encoder).packed({p.encode() for p in pieces}))
    for piece in pieces:
        assert memoryview(packed[piece.encode()]).cast("I").tolist() == (reference._encode_single_piece(piece.encode()) if piece else [])
