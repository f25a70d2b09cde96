"""Operators that need no session: exact round trips and brute force."""

import os
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.compute  # noqa: F401
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
import tiktoken
from tokenizers import Tokenizer

from quillmark.llm import bytebpe, flac, html_blocks, packing, partenum

ALPHABET = "ab'sS tT\n\r\t\x1c\x1f\x85\xa0　éß漢字😀1٣½_#-—́  "


def random_texts(n, longest=40):
    r = random.Random(7)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, longest))) for _ in range(n)]


def test_byte_bpe_equals_the_library():
    codec = bytebpe.ByteBpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), remembered=500)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    r = random.Random(3)
    texts = [*random_texts(2000), "", " ", "\0 a", "x" * 3000, "".join(r.choice("abcdeé") for _ in range(2000)), "<|endoftext|>", "the the the"]
    said = codec.encode_said(texts)
    assert said == [",".join(map(str, other.encode_ordinary(t))) for t in texts]
    assert [codec.decode_said(s).decode() for s in said] == texts


def test_word_tokens_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, other = packing.WordTokenizer(path, remembered=3000), Tokenizer.from_file(path)
    odd = "abcdEFG'stmlvred0123 \n\t\x1c\x85\xa0.,;!?<|>_éßİΣσς\u0345Å\u212b\u0958Ǻ\u0308ᄀ가²½Ⅷ一ǅﬁ\u200b\u3000😀𝒜\x00"
    r = random.Random(3)
    texts = [*random_texts(2000), "Hello, WORLD. it's <|endoftext|> ok.", "x<|startoftext|>y", *("".join(r.choices(odd, k=r.randint(0, 14))) for _ in range(5000))]
    want = [np.array(other.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for step in (len(texts), 700):
        assert [x for i in range(0, len(texts), step) for x in own.encode(pa.array(texts[i : i + step]))] == want


@pytest.mark.parametrize("n", [1, 40, 3000])
def test_plans_give_every_piece_a_slot(n):
    r = random.Random(n)
    lengths = [c for _ in range(n) for c in packing.cuts(r.choice([1, 63, 64, 65, 500, 4096, 9000, r.randint(1, 20000)]))]
    histogram = {x: lengths.count(x) for x in set(lengths)}
    runs = packing.plan(histogram)
    made: dict[int, int] = {}
    for used, times in runs:
        assert sum(x * k for x, k in used) <= packing.CAPACITY
        for x, k in used:
            made[x] = made.get(x, 0) + k * times
    assert made == histogram
    least = -(-sum(lengths) // packing.CAPACITY)
    assert sum(t for _, t in runs) <= least * 1.005 + 2


def test_knapsack_is_exact():
    r = random.Random(5)
    for _ in range(20):
        lengths = np.array(r.sample(range(1, 30), 6))
        prices = np.array([r.random() for _ in lengths])
        best = [0.0] * 51
        for c in range(1, 51):
            best[c] = max([best[c - 1], *[best[c - x] + p for x, p in zip(lengths, prices, strict=True) if x <= c]])
        pattern = packing.best_pattern(prices, lengths, 50)
        assert pattern @ lengths <= 50
        assert pattern @ prices == pytest.approx(best[50])


def test_flac_round_trip_and_checksums():
    payloads = [flac.payload_of(t) for t in [*random_texts(50, 900), None, "", "é" * 30000]] + [os.urandom(192 * 300), bytes(192), bytes([0, 255] * 96)]
    streams = flac.encode(payloads)
    read = flac.decode(streams)
    assert [raw for raw, _ in read] == payloads
    assert all(len(at) * 192 == len(p) for (_, at), p in zip(read, payloads, strict=True))
    assert flac.encode(payloads[:1] * 2) == [streams[0]] * 2
    for at in (60, len(streams[0]) - 1):
        bad = bytearray(streams[0])
        bad[at] ^= 1
        with pytest.raises(ValueError):
            flac.decode([bytes(bad)])
    assert flac.encode([]) == flac.decode([]) == []


PROSE = "The cat was on the mat and it is said that the dog was in the yard for a while with the others of the house."


def test_html_marked_article():
    page = f"<title>no</title><nav><ul><li><a href=/>Home</a></ul></nav><!-- x --><div class='ad'>{PROSE}</div><article><h1>Head &amp; line</h1><p><b>{PROSE}<br>more<p>Short</p><aside>{PROSE}</aside><script>if (a</b) 1</script><p>{PROSE}</p>End.</article><footer>{PROSE}</footer>"
    assert html_blocks.extract_text(page) == "\n\n".join(["Head & line", f"{PROSE} more", "Short", PROSE, "End."])


def test_html_without_marks():
    page = f"<div id='main-menu'><a href=1>Home</a> <a href=2>More</a></div><div class='post'><h2>Title</h2><p>{PROSE}\n\n twice  <p>Tiny</div><form>{PROSE}<input></form><div class='comments'><p>{PROSE}</div><div class=cookie-notice>{PROSE}</div>"
    assert html_blocks.extract_text(page) == "\n\n".join(["Title", f"{PROSE} twice", "Tiny"])
    assert html_blocks.extract_text(None) == html_blocks.extract_text("<<<") .strip("<") == ""


def test_html_reads_long_pages_whole():
    assert html_blocks.extract_text(f"<article>{f'<p>{PROSE}' * 5000}").count("\n\n") == 4999


def test_bands_and_signatures_lose_no_pair():
    ranges = partenum.bands(100000)
    for size in range(1, 3000, 7):
        for other in range(-(-size * 80 // 100), size + 1):
            a, b = (int(np.searchsorted([r for _, r in ranges], x)) for x in (size, other))
            assert a - b in (0, 1)
    r = np.random.default_rng(1)
    for size in [5, 6, 7, 8, 9, 12, 20, 33, 60, 150, 400, 1500]:
        for _ in range(25):
            a = r.integers(0, 1 << 63, size).astype(np.uint64)
            moved = int(r.integers(0, size // 5 + 1))
            kept = a[moved:]
            b = np.concatenate([kept, r.integers(0, 1 << 63, int(r.integers(0, max(1, (100 * len(kept) - 80 * size) // 80 + 1)))).astype(np.uint64)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both) and not np.array_equal(a, b):
                assert len(np.intersect1d(partenum.signatures(a), partenum.signatures(b)))


def test_subsets_of_two_parts_in_a_group_near_enough():
    """Two sets that differ in k shingles have a spare group more than they need, whichever those are."""
    for k in range(1, 400):
        groups, spare = partenum.groups_of(k)
        assert groups - k // 2 == spare + 1 and spare >= 2
    r = np.random.default_rng(3)
    a = np.unique(r.integers(0, 1 << 63, 300).astype(np.uint64))
    k = 2 * int(partenum._ENDS[np.searchsorted(partenum._ENDS, len(a))]) // 9
    groups, spare = partenum.groups_of(k)
    made = partenum.signatures(a)
    assert len(np.unique(made)) == len(made) and len(made) > 2.9 * groups
    assert len(np.intersect1d(made, partenum.signatures(a[1:]))) < len(made)  # a signature holds two parts: one shingle changes two of three
    few = np.unique(r.integers(0, 1 << 63, 12).astype(np.uint64))  # empties are signed where most groups have one
    assert len(partenum.signatures(few))


def test_shingles_are_sets_of_five_words():
    words = [f"w{i % 7}" for i in range(40)]
    brute = {tuple(words[i : i + 5]) for i in range(36)}
    assert len(partenum.shingles(" ".join(words))) == len(brute)
    assert len(partenum.shingles("A b\tC")) == 1
    assert np.array_equal(partenum.shingles("A b\tC"), partenum.shingles("a\n B c"))
    assert len(partenum.shingles(" \n")) == len(partenum.shingles(None)) == 0


def test_wrappers_and_paragraph_names_cost_no_text():
    story = "The story of the house is that it was sold to the man in the end."
    more = story + " And so it was that more of the same came to be told in the town, for the man and the house were known to all of it."
    extract = html_blocks.extract_text
    assert extract(f'<div class="page has-sidebar"><article><p>{story}</p></article><div class="sidebar"><p>{more}</p></div></div>') == story
    assert extract(f"<form id=f><article><h1>T</h1><p>{story}</p></article></form>") == f"T\n\n{story}"
    assert extract(f'<div class="with-comments"><p>{more}</p><p>{story}</p></div>') == f"{more}\n\n{story}"
    assert extract(f'<article><p>{story}</p><p class="share-price">Up 3 %</p><ul><li><a href=x>A reference</a></ul></article><div class="comments"><p>{more}</p></div>') == f"{story}\n\nUp 3 %\n\nA reference"
    assert extract(f"<ul><li><a href=a>One</a><li><a href=b>Two and more</a></ul><p>Short.</p><p>{more}</p><p>{more}</p><footer><p>{story}</p></footer>") == f"Short.\n\n{more}\n\n{more}"


def test_each_rule_decides_blocks_of_its_kind():
    story = "The story of the house is that it was sold to the man in the end, and more of the same came after it."
    blocks, holders = html_blocks.blocks_of(f"<p>{story}</p><p>Short.</p><ul><li><a href=a>A list of links here</a></ul><nav>Menu</nav>")
    assert html_blocks.decisions(blocks, holders) == [(True, "prose"), (True, "neighbour"), (False, "links"), (False, "apart")]


def foreign_flac(frames):
    """A stream put together bit by bit: 16 bits a sample, blocks of any size, each subframe as given."""
    out, samples = b"", []
    for number, (size, subframe, own) in enumerate(frames):
        head = f"{0x7FFC:015b}" + "0" + "0111" + "0000" + "0000" + "100" + "0" + f"{number:08b}" + f"{size - 1:016b}"
        raw = int(head, 2).to_bytes(len(head) // 8, "big")
        crc = lambda b, table, width: int(flac._crc(np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)]), table, width)[0])
        raw += bytes([crc(raw, flac.CRC8, 8)])
        body = subframe + "0" * (-len(subframe) % 8)
        raw += int(body, 2).to_bytes(len(body) // 8, "big")
        out += raw + crc(raw, flac.CRC16, 16).to_bytes(2, "big")
        samples += own
    packed = 44100 << 44 | 15 << 36 | len(samples)
    digest = hashlib.md5(b"".join(v.to_bytes(2, "little", signed=True) for v in samples)).digest()
    return b"fLaC" + bytes([0, 0, 0, 34]) + bytes(10) + packed.to_bytes(8, "big") + digest + bytes([0x81, 0, 0, 3]) + b"pad" + out, samples


def test_flac_of_another_encoder():
    bits = lambda v, n: f"{v & ((1 << n) - 1):0{n}b}"
    rice = lambda v, k: "0" * ((2 * v if v >= 0 else -2 * v - 1) >> k) + "1" + (bits((2 * v if v >= 0 else -2 * v - 1), k) if k else "")
    constant = (5, "0" + "000000" + "0" + bits(-7, 16), [-7] * 5)
    verbatim = (3, "0" + "000001" + "0" + bits(1, 16) + bits(-2, 16) + bits(30000, 16), [1, -2, 30000])
    ramp = [10, 13, 17, 16, 12, 4, -9, -30]
    steps = [b - a for a, b in zip(ramp, ramp[1:])]
    # First differences in two partitions, the second with raw values of six bits.
    fixed = (8, "0" + "001001" + "0" + bits(10, 16) + "00" + "0001" + bits(2, 4) + "".join(rice(v, 2) for v in steps[:3]) + "1111" + bits(6, 5) + "".join(bits(v, 6) for v in steps[3:]), ramp)
    # Second-order prediction 2a - b, halved values (one wasted bit), five-bit parameters.
    even = [4, 8, 14, 20, 30, 28]
    half = [v // 2 for v in even]
    left = [half[i] - ((half[i - 1] * 4 - half[i - 2] * 2) >> 1) for i in range(2, 6)]
    lpc = (6, "0" + "100001" + "1" + "1" + bits(half[0], 15) + bits(half[1], 15) + bits(3, 4) + bits(1, 5) + bits(4, 4) + bits(-2, 4) + "01" + "0000" + bits(1, 5) + "".join(rice(v, 1) for v in left), even)
    stream, samples = foreign_flac([constant, verbatim, fixed, lpc])
    depth, got, places = flac.decode_any(stream)
    assert (depth, got, [p for p, _ in places]) == (16, samples, [0, 5, 8, 16])
    for i in range(46, len(stream), 5):
        with pytest.raises(ValueError):
            flac.decode_any(stream[:i] + bytes([stream[i] ^ 4]) + stream[i + 1 :]) if i > 52 else flac.decode_any(stream[:i])
    own = flac.encode([flac.payload_of("Some text for both decoders. " * 40)])
    _, plain, _ = flac.decode_any(own[0])
    assert bytes(v + 128 for v in plain) == flac.decode(own)[0][0]


def test_density_decides_inside_a_marked_article():
    story = "The story of the house is that it was sold to the man in the end, and more of the same came after it."
    links = "".join(f"<p><a href={i}>Read more about part {i} here</a></p>" for i in range(5))
    extract = html_blocks.extract_text
    assert extract(f"<article>{links}</article>") == ""
    assert extract(f"<article><h1>Head</h1><p>{story}</p><p>Short.</p>{links}<p>Near the list</p></article>") == f"Head\n\n{story}\n\nShort."
    assert extract(f"<article><p>{story}</p><p><a href=x>A single link</a></p><p>{story}</p></article>") == f"{story}\n\nA single link\n\n{story}"
    blocks, holders = html_blocks.blocks_of(f"<article><p>{story}</p>{links}<p>Near the list</p></article>")
    off = html_blocks.decisions(blocks, holders, max_link_density=1.0)
    assert [x for x, _ in off] == [True] * 7 != [x for x, _ in html_blocks.decisions(blocks, holders)]
