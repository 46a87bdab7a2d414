"""Operators that take a text at a time, against libraries and plain versions."""

import io
import os
import random
import struct
import time
import zipfile
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from freightlens.llm import pseudo_likelihood as lm
from freightlens.llm import quality_rules as quality
from freightlens.llm.html_paths import blocks, extract_text, main_text, path_values
from freightlens.llm.sentencepieces import Codec, Pieces, decode, encode, round_trip
from freightlens.llm.token_counts import token_counts
from freightlens.llm.token_store import Encoder, pack, read_token_store, unpack, write_token_store
from freightlens.llm.warc import parse, read_packages, record, write_packages
from freightlens.llm.zip_archive import ZipArchive
from pyspark.sql import functions as F
from tests.llm import plain
from tests.llm.cases import documents, frame, got, want

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def ids_of(library, rows):
    return [e.ids for e in library.encode_batch_fast([t or "" for _, t in rows], add_special_tokens=False)]


def random_texts(n, alphabet="aäst  '’\n\tr e l1.!v　d'm漢aaaa😀-=--"):
    draw = random.Random(n)
    return [(i, "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 40)))) for i in range(n)]


def test_token_counts(spark, library):
    rows = documents() + random_texts(3000)
    expected = [(d, len((t or "").encode()), len(ids), len(ids) > 512) for (d, t), ids in zip(rows, ids_of(library, rows))]
    assert got(token_counts(frame(spark, rows), BPE)) == want(expected)
    assert token_counts(frame(spark, rows).limit(0), BPE).count() == 0


def test_token_store_round_trip(spark, library):
    rows = [(d, t) for d, t in documents() if d is not None]
    rows = list({d: (d, t) for d, t in rows}.values()) + [(None, "no id")]
    order = sorted(rows, key=lambda r: -(2**63) if r[0] is None else r[0])
    expected, start = [], 0
    for (d, _), ids in zip(order, ids_of(library, order)):
        expected.append((d, start, len(ids) + 1, plain.crc([*ids, 0])))
        start += len(ids) + 1
    folder = write_token_store(frame(spark, rows), BPE)
    assert got(read_token_store(spark, folder)) == want(expected)
    assert read_token_store(spark, write_token_store(frame(spark, rows).limit(0), BPE)).count() == 0


def test_token_store_of_repeated_and_missing_ids(spark, library):
    rows = documents() + [(None, t) for _, t in documents()[:30]] + [(5, f"five {i}") for i in range(30)] + [(None, None)] * 5
    expected = want((d, len(ids) + 1, plain.crc([*ids, 0])) for (d, _), ids in zip(rows, ids_of(library, rows)))
    found = []
    for docs in (frame(spark, rows), frame(spark, rows[::-1]).repartition(9)):
        back = read_token_store(spark, write_token_store(docs, BPE))
        assert got(back, "doc_id", "n_tokens", "ids_crc32") == expected
        found.append(sorted(back.collect(), key=lambda r: r.start))
    assert found[0] == found[1]  # the order of rows of one id is that of their texts
    ends = np.cumsum([r.n_tokens for r in found[0]])
    assert [r.start for r in found[0]] == [0, *ends[:-1].tolist()]
    ids = [-1 if r.doc_id is None else r.doc_id for r in found[0]]
    assert ids == sorted(ids)


def test_long_pre_tokens_keep_all_their_ids(library):
    encode = Encoder(Path(BPE).read_text(encoding="utf-8"))
    texts = ["=-" * 40_000 + " a", "b a", "=-" * 40_000]
    for _ in range(2):
        ids, sizes = encode(texts)
        expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == [i for e in expected for i in e] and sizes.tolist() == [len(e) for e in expected]


def test_packed_ids_come_back():
    draw = np.random.default_rng(1)
    for ids in (np.empty(0, np.uint32), np.zeros(5), np.arange(70_000), draw.zipf(1.3, 5001) % 2**31, np.array([2**32 - 1, 0, 7, 2**24])):
        ids = np.asarray(ids).astype(np.uint32)
        assert (unpack(*pack(ids), len(ids)) == ids).all()
    assert len(pack(np.zeros(400, np.uint32))[2]) == 400  # the commonest id takes one byte
    with pytest.raises(ValueError):
        unpack(*pack(np.arange(9))[:2], np.empty(3, np.uint8), 9)


def best_score(pieces, data):
    """Greatest sum of scores over all ways to cut the bytes."""
    known = {s: pieces.scores[i] for i, s in enumerate(pieces.surfaces) if pieces.kinds[i] == 1}
    low = min(known.values()) - 10
    best = [0.0] + [-np.inf] * len(data)
    for a in range(len(data)):
        if best[a] == -np.inf:
            continue
        for b in range(a + 1, min(len(data), a + 60) + 1):
            if data[a:b] in known:
                best[b] = max(best[b], best[a] + known[data[a:b]])
        width = next(k for k in (1, 2, 3, 4) if a + k == len(data) or data[a + k] & 0xC0 != 0x80)
        if data[a:a + width] not in known:
            best[a + width] = max(best[a + width], best[a] + low)
    return best[-1]


def test_pieces_are_the_best_path():
    pieces = Pieces.from_file(PIECES)
    codec = Codec(pieces)
    texts = [t for _, t in random_texts(60, "the ing é漢\n😀▂ er")] + ["Hello  wörld", "a" * 300]
    ids, counts = codec.encode(texts)
    assert codec.decode(ids, counts) == texts
    low = pieces.scores[pieces.kinds == 1].min() - 10
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends):
        if text and not any(pieces.kinds[i] == 6 for i in ids[a:b]):
            assert sum(pieces.scores[ids[a:b]]) == best_score(pieces, ("▁" + text.replace(" ", "▁")).encode())
    ids, counts = codec.encode(["漢"])  # no piece: the bytes' pieces
    assert low < 0 and [pieces.surfaces[i] for i in ids] in ([b"\xe2\x96\x81\xe6\xbc\xa2"], [b"\xe2\x96\x81", b"\xe6\xbc\xa2"],
                                                             [b"\xe2\x96\x81", b"<0xE6>", b"<0xBC>", b"<0xA2>"])


def test_pieces_agree_with_the_library_on_words():
    import sentencepiece

    with open(PIECES, "rb") as file:
        raw = file.read()
    from freightlens.llm.sentencepieces import _fields

    trainer = next(v for f, v in _fields(raw) if f == 2)
    at = raw.index(trainer) + trainer.index(b"\x18\x02")  # model_type: merges, made unigram
    library = sentencepiece.SentencePieceProcessor()
    library.LoadFromSerializedProto(raw[:at] + b"\x18\x01" + raw[at + 2:])
    pieces = Pieces.from_file(PIECES)
    codec = Codec(pieces)
    draw = random.Random(3)
    words = ["".join(draw.choice(["th", "er", "in", "on", "a", "e", "tion", "st"]) for _ in range(draw.randint(1, 5))) for _ in range(2000)]
    ids, counts = codec.encode(words)
    ends = np.cumsum(counts)
    ours = [ids[a:b].tolist() for a, b in zip(ends - counts, ends)]
    theirs = [library.nbest_encode_as_ids(w, 2)[0] for w in words]  # its whole lattice; the short cut of encode() is not always the best path
    score = lambda x: sum(pieces.scores[x])
    assert [score(x) for x in ours] == [score(y) for y in theirs]
    assert sum(x != y for x, y in zip(ours, theirs)) <= 0.002 * len(words)  # ties


def test_piece_frames(spark):
    rows = documents()
    encoded = encode(frame(spark, rows), PIECES)
    assert got(decode(encoded, PIECES)) == want((d, t or "") for d, t in rows)
    report = round_trip(frame(spark, rows), PIECES)
    assert report.where("not round_trip").count() == 0
    sizes = encoded.select("doc_id", F.size("ids").cast("long"))
    assert got(report, "doc_id", "n_pieces") == got(sizes)
    assert encode(frame(spark, rows).limit(0), PIECES).count() == 0


PAGES = [
    ('<body><nav><a href="/">Home</a></nav><div class="ad">Buy, now. Cheap!</div><article><h1>T &amp; U</h1><p>One, two. three\n  four.<br>five'
     '<p><b>Six</b>th, &quot;seven&quot;. eight</p><script>var a="</p>";</script></article><footer>&copy; x</footer>', "T & U\nOne, two. three four. five\nSixth, \"seven\". eight"),
    ('<html><body class="has-sidebar"><header>Site name</header><div id="main-text"><h2>Title</h2><p>Long text, with commas. And more of it, here.</p>'
     '<p>Another paragraph, as long. As the first one, or so.</p></div><aside><p>Read also, this. Please do.</p></aside>'
     '<div class="comments"><p>Nice post, thanks. So much, really, indeed, yes.</p></div><form>Name, mail.</form></body>',
     "Title\nLong text, with commas. And more of it, here.\nAnother paragraph, as long. As the first one, or so."),
    ("<p>a < b and <i>c</i>d<!-- no -->e", "a < b and cde"), ("", ""), (None, ""), ("<nav>x</nav>", ""), ("<article>cut <a href=\"x", "cut"),
]


def test_main_text(spark):
    for page, text in PAGES:
        assert main_text(page or "") == text
    rows = [(i, None if i == 2 else "u", p) for i, (p, _) in enumerate(PAGES)] + [(None, "u", PAGES[0][0]), (0, "u", PAGES[0][0])]
    out = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    texts = [t for _, t in PAGES] + [PAGES[0][1]] * 2
    assert got(out, "page_id", "url", "text", "n_chars") == want((r[0], r[1], t, len(t)) for r, t in zip(rows, texts))
    assert out.limit(0).count() == 0


def test_long_page():
    assert main_text("<article>" + "<p>word, and.</p>" * 20_000 + "</article>").count("\n") == 19_999
    assert main_text("<div>" + "<p>word, and.</p>" * 20_000 + "</div>").count("\n") == 19_999
    assert main_text("<div class=deep>word, and." * 5_000).count("\n") > 4_000


def said(n, seed=0):
    """A paragraph of n sentences."""
    draw = random.Random(seed * 100 + n)
    word = lambda: "".join(draw.choice("abcdeiknorstuéß") for _ in range(draw.randint(2, 8)))
    return " ".join(" ".join(word() for _ in range(draw.randint(4, 9))).capitalize() + ", " + word() + "." for _ in range(n))


NAV = '<nav class="top"><ul><li><a href="/a">Home</a><li><a href="/b">All of our posts</a></ul></nav>'
SIDE = '<div class="sidebar-left"><h3>Most read</h3><ul><li><a href="/1">One, two</a><li><a href="/2">Three</a></ul></div>'
FOOT = "<footer><p>&copy; 2024 Someone, somewhere. All rights reserved.</p></footer>"
SAID = '<div id="comments"><h3>2 comments</h3><div class="c"><p>Great post, thanks. I read it twice.</p></div></div>'
COOKIE = '<div class="cookie-banner" role="dialog"><p>We use cookies, of course. Accept all, or leave.</p><button>OK</button></div>'


def layouts(n):
    """(html, blocks) of pages of fourteen layouts; n moves lengths and texts."""
    a, b, c, d = (said(k + n, k) for k in (2, 3, 1, 4))
    p = lambda *texts: "".join(f"<p>{t}</p>" for t in texts)
    yield f"<html><body>{NAV}<div class=ad>Buy, now.</div><article><h1>Title</h1>{p(a, b)}<p>Ok.</p>{p(c)}</article>{SAID}{FOOT}", ["Title", a, b, "Ok.", c]
    yield (f"<body>{COOKIE}<header><h2>The Site</h2></header><main><header><h1>Head</h1></header>{p(a)}<h2 id=comments>On comments</h2>{p(b)}"
           f"<blockquote>{c}</blockquote><form><label>Mail</label><input></form></main><aside>{p(d)}</aside>{FOOT}"), ["Head", a, "On comments", b, c]
    yield f"<body>{NAV}<div id=content><h1>Title</h1>{p(a, b, d)}</div>{SIDE}{SAID}{FOOT}", ["Title", a, b, d]
    yield (f"<table><tr><td><a href=/>Home</a><br><a href=/x>Contact us now</a></td><td class=text>{p(a, b, d)}</td></tr></table>"), [a, b, d]
    yield f"<h1>Bare</h1><p>{a}<p>{b}<p>{d}", ["Bare", a, b, d]
    yield (f"<body><form id=aspnet action=/><input type=hidden value=x>{NAV}<div class=body>{p(a, b)}<ul><li>{c}</li><li>Two.</li></ul>{p(d)}</div></form>{FOOT}",
           [a, b, c, "Two.", d])
    yield (f"<article><h1>A</h1><section class=social-history>{p(a)}</section><figure><img src=x><figcaption>Seen, here.</figcaption></figure>"
           f"<div class='share comments'>{p(d)}</div><pre>x  =\n1</pre><table><tr><td>1<td>2</table>{p(b)}</article>"), ["A", a, "Seen, here.", "x = 1", "1", "2", b]
    yield (f"<body><div class='page with-sidebar'><div class=entry><h2>Part one</h2>{p(a, b)}<h2>Part two</h2>{p(d)}</div>{SIDE}</div>{FOOT}",
           ["Part one", a, b, "Part two", d])
    yield f"<article lang=en title=it's data-x='a>b' data-y=\"it's\"><p id=a'b>{a}</p><p title='>'>{b} it's</p></article><!-- {c} -->", [a, f"{b} it's"]
    yield (f"<body><noscript><p>Please enable it.</p></noscript><main>{p(a)}<noscript>{p(b)}</noscript><p>{c} <math><mi>x</mi><mo>=</mo><mn>2</mn></math>"
           f"<object data=x>!</object></p><svg><title>no</title><text>no</text></svg><template><p>no</p></template></main>"), [a, b, f"{c} x=2!"]
    yield (f"<body>{NAV}<article><h1>Main one</h1>{p(a, b, d, d)}</article><aside><article><p>Related, short.</p></article></aside>"
           f"<div class='newsletter-signup'>{p(c)}</div>{FOOT}"), ["Main one", a, b, d, d]
    yield (f"<body><div role=banner>{p('The site, again.')}</div><div role=main><section><h2>One</h2>{p(a)}</section><section><h2>Two</h2>{p(b, d)}</section></div>"
           f"<div role=contentinfo>{p('Made, here.')}</div>"), ["One", a, "Two", b, d]
    yield (f"<div class=post><dl><dt>Term<dd>{a}<dt>Other<dd>{b}</dl>{p(d)}</div><div class='ad-slot'>{p('Buy, two. Get, one.')}</div>"), ["Term", a, "Other", b, d]
    yield f"<article><script>if (a < b) '</p>'</script><style>p{{}}</style><p>{a}<br>{b}</p><svg><p>{c}</p><p>{d}</p></article>", [f"{a} {b}", c, d]


@pytest.mark.parametrize("n", [0, 2, 7])
def test_layouts(n):
    pages = list(layouts(n))
    assert len(pages) == 14 and sum("<article" not in page for page, _ in pages) >= 7
    for page, expected in pages:
        assert main_text(page).split("\n") == expected


def test_tags_end_where_markup_says():
    assert main_text("<article><p title=it's>Hello world</p><p>it's fine</p></article>") == "Hello world\nit's fine"
    assert main_text('<article><p>a</p><noscript><p>inside</p></noscript><p>b<object>alt</object></p></article>') == "a\ninside\nbalt"
    assert main_text('<article><p a="open>one</p><p>two</p></article>') == "one\ntwo"
    assert main_text("<article><p a = 'x' b=/c/d>one</p><p / class=q>two &lt;b&gt; < 3</p></article>") == "one\ntwo <b> < 3"


def test_names_that_mark_everything_mark_nothing():
    assert main_text("<div class=comments><p>One, two. Three, four.</p><p>Five, six. Seven.</p></div>") == "One, two. Three, four.\nFive, six. Seven."
    values, threshold = path_values(blocks("<div><h2>Short</h2><p>Long text, with commas. Very long.</p></div>"))
    values = {str(path): value for path, value in values.items()}
    assert values["/div/p"] > threshold > 0 and values["/div/p"] > values["/div/h2"]


def test_quality_rules(spark):
    rows = documents() + [(2000 + i, t) for i, (_, t) in enumerate(random_texts(300, "ab é\n\t|\x85 a b"))]
    rows += [(3000, " ".join(f"word{i * 7919 % 1000}" for i in range(900))), (3001, os.urandom(4000).hex()), (3002, "a b c d e f g h i j\n" * 60)]
    expected = [(d, *plain.base_counts(t), *plain.good(t, quality.Bands())) for d, t in rows]
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert got(quality.quality_rules(frame(spark, rows)), *columns) == want(expected)
    kept = quality.keep_good(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert got(kept, "doc_id", "text") == want((d, t) for d, t in rows if plain.good(t, quality.Bands())[1])
    assert quality.keep_good(frame(spark, rows).limit(0)).count() == 0


def syllables(n, seed=5):
    """Prose of n bytes."""
    draw = random.Random(seed)
    some = [a + b for a in "bcdfglmnprst" for b in ("a", "e", "in", "or")]
    return " ".join("".join(draw.choice(some) for _ in range(draw.randint(1, 5))) for _ in range(n // 4 + 9))[:n]


def noise(n, seed=1):
    import base64

    return base64.b64encode(random.Random(seed).randbytes(n)).decode()[:n]


def test_limits_of_the_bands_are_those_stated():
    assert quality.Bands() == quality.Bands(
        whole=((256, 0.20, 1.20), (512, 0.49, 0.86), (1024, 0.455, 0.80), (2048, 0.44, 0.74), (4096, 0.42, 0.70), (8192, 0.405, 0.66),
               (16384, 0.39, 0.64), (65536, 0.37, 0.62), (float("inf"), 0.35, 0.62)),
        chunk=4096, chunk_lowest=0.40, chunk_highest=0.70, chunk_share=0.25, short_chunks=((256, 0.88), (512, 0.78)), level=3, min_words=50,
        max_repeat_percent=50)


def test_a_tail_of_noise_is_judged_like_any_chunk(spark):
    rows = [(i, syllables(a) + " " * (a > 0) + noise(b)) for i, (a, b) in enumerate(
        [(4096, 3900), (8192, 4000), (1500, 900), (4096, 0), (8192, 0), (1500, 0), (4096, 300), (16000, 4000), (20000, 4095), (70000, 30000), (255, 0), (257, 0)])]
    expected = [(d, plain.good(t, quality.Bands())[1]) for d, t in rows]
    assert [k for _, k in expected][:6] == [False, False, False, True, True, True]
    assert got(quality.quality_rules(frame(spark, rows)), "doc_id", "kept") == want(expected)


@pytest.mark.parametrize("size", [200, 256, 300, 511, 1024, 4095, 4096, 5000, 16383, 16384, 30001])
def test_verdict_turns_at_every_limit(size):
    import zstandard

    packer, text = zstandard.ZstdCompressor(level=3), syllables(size - size // 9) + noise(size // 9)
    raw = text.encode()
    ratio = lambda b: len(packer.compress(b)) / len(b)
    open_ = dict(whole=((float("inf"), 0.0, 9.0),), chunk_lowest=0.0, chunk_highest=9.0, short_chunks=((256, 9.0), (512, 9.0)), chunk_share=0.0,
                 min_words=0, max_repeat_percent=100)

    def both(**limits):
        bands = quality.Bands(**{**open_, **limits})
        ours, theirs = quality.compression(memoryview(raw), packer, bands)[3], plain.good(text, bands)[1]
        assert ours == theirs
        return ours

    up, down = lambda x: float(np.nextafter(x, 9)), lambda x: float(np.nextafter(x, -9))
    whole = ratio(raw)
    assert both() and both(whole=((float("inf"), whole, whole),))
    assert not both(whole=((float("inf"), up(whole), 9.0),)) and not both(whole=((float("inf"), 0.0, down(whole)),))
    assert both(whole=((size, whole, whole), (float("inf"), 9.0, 9.0))) and not both(whole=((size - 1, whole, whole), (float("inf"), 9.0, 9.0)))
    for chunks in plain.chunks_of(raw, quality.Bands()):
        least, most, c = min(map(ratio, chunks)), max(map(ratio, chunks)), len(chunks[0])
        name = {256: "a", 512: "b"}.get(c)
        highest = lambda x: ({"short_chunks": ((256, x), (512, 9.0))} if name == "a" else {"short_chunks": ((256, 9.0), (512, x))} if name
                             else {"chunk_highest": x})
        if len(plain.chunks_of(raw, quality.Bands())) == 1 or c == 4096 or name:
            assert not both(**highest(down(most)))
        assert both(**highest(9.0)) and (least == 0 or not both(chunk_lowest=up(max(min(map(ratio, x)) for x in plain.chunks_of(raw, quality.Bands())))))
        outside = sum(ratio(x) >= most for x in chunks)
        assert both(**highest(down(most)), chunk_share=1.0)
        if len(plain.chunks_of(raw, quality.Bands())) == 1:
            assert both(**highest(down(most)), chunk_share=outside / len(chunks)) and not both(**highest(down(most)), chunk_share=down(outside / len(chunks)))
    n = len(plain.blank_words(text))
    counted = quality._judged
    for limits in (dict(min_words=n), dict(min_words=n + 1), dict(max_repeat_percent=0), dict(max_repeat_percent=100)):
        bands = quality.Bands(**{**open_, **limits})
        found = counted(pa.array([text, text + " x y z x y z"]), packer, bands)
        assert found["kept"].tolist() == [plain.good(t, bands)[1] for t in (text, text + " x y z x y z")]


def test_bands_tell_noise_and_repetition_from_prose():
    import zstandard

    draw, packer = random.Random(5), zstandard.ZstdCompressor(level=3)
    verdict = lambda raw: quality.compression(memoryview(raw), packer, quality.Bands())[3]
    assert not verdict(os.urandom(5000)) and not verdict(b"the same words again. " * 300)
    syllables = [a + b for a in "bcdfglmnprst" for b in ("a", "e", "in", "or")]
    prose = " ".join("".join(draw.choice(syllables) for _ in range(draw.randint(1, 5))) for _ in range(900)).encode()
    assert verdict(prose)
    assert not verdict(prose[:4096] + b"z" * 8192)  # two of three chunks lie outside


def test_every_byte_is_in_a_chunk():
    import base64

    import zstandard

    draw, bands, packer = random.Random(6), quality.Bands(), zstandard.ZstdCompressor(level=3)
    judged = lambda raw: quality.compression(memoryview(raw), packer, bands)
    syllables = [a + b for a in "bcdfglmnprst" for b in ("a", "e", "in", "or")]
    prose = " ".join("".join(draw.choice(syllables) for _ in range(draw.randint(1, 5))) for _ in range(3000)).encode()
    noise = base64.b64encode(random.Random(7).randbytes(9000))
    for size, added in ((4096, 3900), (8192, 4000), (4096, 2500), (1500, 900), (600, 400)):
        assert judged(prose[:size + added])[3] and not judged(prose[:size] + noise[:added])[3]
    for size in (256, 257, 700, 3000, 4095, 4096, 4097, 8191, 16_383, 16_385):
        chunks = quality.chunk_sizes(size, bands)
        assert chunks and judged(prose[:size])[1] == sum(-(-size // c) for c in chunks)


def test_warc_packages(spark):
    long = "<p>" + "é" * 600
    rows = [(1, "http://a/1", long), (2, "http://a/2\r\nx", long), (3, None, long), (None, "u", long), (4, "u", "short"), (5, "u", "short"), (6, "u", None),
            (7, "u", "<p>" + "b" * 2000), (3, None, long)]
    import hashlib

    expected = []
    for page, _, html in rows:
        raw = (html or "").encode()
        revisit = html == long and page != 3
        expected.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, refers_to int, payload_digest string").repartition(3)
    out = read_packages(spark, write_packages(pages))
    assert got(out, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == want(expected)
    assert read_packages(spark, write_packages(pages.limit(0))).count() == 0


def test_small_warc_packages_share_files_and_tasks(spark, tmp_path):
    held = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(k) for k in held]
    pages = spark.createDataFrame([(i, "u", f"<p>{i}" + "c" * 1500 * (i % 3)) for i in range(90)], "page_id long, url string, html string")
    try:
        for k, v in zip(held, ("false", "23")):
            spark.conf.set(k, v)
        folder = write_packages(pages.union(pages), str(tmp_path))
        out = read_packages(spark, folder)
        listed = spark.read.parquet(f"{folder}/packages")
        assert listed.count() > 15 and len(listed.inputFiles()) == 1 and listed.agg({"n_records": "sum"}).first()[0] == 180
        assert listed.agg({"n_bytes": "sum"}).first()[0] == sum(f.stat().st_size for f in tmp_path.glob("pages-wacz-*"))
        assert out.rdd.getNumPartitions() == 1 and sorted(r.page_id for r in out.collect()) == sorted([*range(90)] * 2)
    finally:
        for k, v in zip(held, before):
            spark.conf.set(k, v)


def test_warc_record_parses():
    raw = record(5, "http://x/ y", b"body\r\n\r\nmore", "ab" * 20, None, False)
    fields, reply, payload = parse(raw)
    assert payload == b"body\r\n\r\nmore" and fields["warc-target-uri"] == "http://x/%20y" and reply["content-length"] == "12"


class Bytes(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        return self.getvalue()[at:at + n]


def test_zip_directory_with_64_bit_fields():
    out = Bytes()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        for i in range(66_000):  # more members than the plain end record can count
            archive.writestr(f"m{i}", b"%d" % i)
        with archive.open("wide", "w", force_zip64=True) as member:
            member.write(b"0123456789")
        archive.comment = b"PK\5\6 in a comment"
    found = ZipArchive(out)
    assert len(found.members) == 66_001 and found.read("m65999") == b"65999" and found.read("wide", 3, 4) == b"3456"
    with pytest.raises(ValueError):
        found.read("wide", 8, 5)
    with pytest.raises(ValueError):
        ZipArchive(Bytes(b"no archive"))
    # sizes and place of a member in the 64-bit extra field of the directory
    name, data = b"big", b"payload"
    local = b"PK\3\4" + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, len(data), len(data), len(name), 0) + name + data
    extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), 0)
    entry = b"PK\1\2" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 2**32 - 1, 2**32 - 1, len(name), len(extra), 0, 0, 0, 0, 2**32 - 1) + name + extra
    end64 = b"PK\6\6" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), len(local))
    tail = b"PK\6\7" + struct.pack("<IQI", 0, len(local) + len(entry), 1) + b"PK\5\6" + struct.pack("<HHHHIIH", 0, 0, 65535, 65535, 2**32 - 1, 2**32 - 1, 0)
    assert ZipArchive(Bytes(local + entry + end64 + tail)).read("big") == data
    packed = Bytes()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("a", "b" * 99)
    with pytest.raises(ValueError):
        ZipArchive(packed).read("a")


SMALL = lm.Shape(common=40, endings=24, per_class=13, width=8, batch=256, rounds=2, blocks=3)


def test_pseudo_likelihood_learns(spark):
    draw = random.Random(2)
    sentence = lambda: f"{(a := draw.choice(['red', 'blue', 'green']))} {a}ish {draw.choice(['cat', 'dog'])} sees {a} {a}ish things"
    rows = [(i, " ".join(sentence() for _ in range(30))) for i in range(120)]
    held = [(1000, " ".join(sentence() for _ in range(30)))]
    words = held[0][1].split()
    draw.shuffle(words)
    held += [(1001, " ".join(words)), (1002, None), (1003, " "), (None, "red redish"), (1000, "x")]
    out = lm.pseudo_likelihood(frame(spark, rows + held), SMALL)
    assert out.count() == len(rows + held)
    scored = {(r.doc_id, r.n_words): r for r in out.collect()}
    text, shuffled = scored[1000, len(words)], scored[1001, len(words)]
    assert text.mean_log_likelihood > shuffled.mean_log_likelihood + 1 and text.mean_log_likelihood > -1.6
    assert abs(text.log_likelihood - text.mean_log_likelihood * text.n_words) < 1e-6
    assert scored[1002, 0].log_likelihood == 0 and scored[1003, 0].mean_log_likelihood is None
    assert lm.pseudo_likelihood(frame(spark, rows).limit(0), SMALL).count() == 0


def plain_score(model, text):
    """Sum of the log-probabilities of a text's words, one word and one class at a time."""
    shape, w = model.shape, lm.Network(model.shape).load(model.state).weights
    counted = {r.word: r.n for r in model.counts.collect()}
    data = np.frombuffer((text or "").encode(), np.uint8)
    _, hashes, endings = lm._words(data, np.array([0, len(data)]))
    names = [0] * shape.side + model.names.of(hashes, endings).tolist() + [0] * shape.side
    log_softmax = lambda x, k: float(x[k] - np.log(np.exp(x.astype(float)).sum()))
    total = 0.0
    for i, h in enumerate(hashes):
        at = i + shape.side
        around = [names[at - k - 1] for k in range(shape.side)] + [names[at + k + 1] for k in range(shape.side)]
        hidden = np.tanh(w["bias"] + sum(w["context"][k][n] for k, n in enumerate(around)))
        kind, place = divmod(names[at], shape.per_class)
        total += log_softmax(w["classes"] @ hidden + w["class_bias"], kind) + log_softmax(w["words"][kind] @ hidden + w["word_bias"][kind], place)
        if names[at] > shape.common:
            n = counted.get(int(np.uint64(h).astype(np.int64)), 0)
            total += np.log(n - lm.DISCOUNT if n else lm.DISCOUNT) - model.totals[names[at] - shape.common - 1]
    return len(hashes), total


def test_scores_of_any_layout_are_those_of_a_plain_loop(spark):
    rows = [(d, t) for d, t in documents() if t is None or len(t) < 3000]
    docs = frame(spark, rows)
    model = lm.fit(docs, SMALL, shard_words=500)
    expected = sorted((n, round(total, 3)) for n, total in (plain_score(model, t) for _, t in rows))
    for parts in (1, 7, 40):
        found = lm.pseudo_likelihood(docs.repartition(parts), SMALL, shard_words=500).collect()
        for (n, total), (m, got_total) in zip(expected, sorted((r.n_words, round(r.log_likelihood, 3)) for r in found)):
            assert n == m and abs(total - got_total) < 0.01 + 1e-4 * abs(total)


def test_gradients_are_finite_differences():
    draw = np.random.default_rng(3)
    windows, targets = draw.integers(0, SMALL.vocabulary, (400, 4)), draw.integers(1, SMALL.vocabulary, 400)
    network = lm.Network(SMALL)
    before = {k: w.copy() for k, w in network.weights.items()}
    network.squares = {k: np.full(s.shape, 1e-12, np.float32) for k, s in network.squares.items()}
    network.learn(windows, targets)
    gradient = {k: np.sign(before[k] - network.weights[k]) * np.sqrt(np.maximum(network.squares[k] - 1e-12, 0)) for k in before}
    for name, w in before.items():
        for at in draw.choice(w.size, min(6, w.size), replace=False).tolist() + [int(np.abs(gradient[name]).argmax())]:
            sides = []
            for step in (0.01, -0.01):
                moved = {k: v.astype(np.float64) for k, v in before.items()}
                moved[name].flat[at] += step
                sides.append(lm.Network(SMALL, moved).log_probabilities(windows, targets).astype(float).mean())
            assert abs(-(sides[0] - sides[1]) / 0.02 - gradient[name].flat[at]) < 2e-4


class RowByRow(lm.Network):
    """The network's formulas with a row a word and a softmax a class."""

    def split(self, windows, targets):
        w, per = self.weights, self.shape.per_class
        order = np.argsort((targets // per).astype(np.uint16), kind="stable")
        windows, targets = windows[order], targets[order]
        total = w["bias"] + w["context"][0][windows[:, 0]]
        for k in range(1, windows.shape[1]):
            total += w["context"][k][windows[:, k]]
        cuts = np.searchsorted(targets // per, np.arange(len(w["classes"]) + 1)).tolist()
        return order, windows, targets, np.tanh(total), [(c, a, b) for c, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]

    @staticmethod
    def softmax(logits):
        logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(1, keepdims=True)
        return logits

    def log_probabilities(self, windows, targets):
        w, per, out = self.weights, self.shape.per_class, np.empty(len(targets), np.float32)
        order, _, targets, hidden, runs = self.split(windows, targets)
        logs = np.log(self.softmax(hidden @ w["classes"].T + w["class_bias"])[np.arange(len(targets)), targets // per])
        for c, a, b in runs:
            logs[a:b] += np.log(self.softmax(hidden[a:b] @ w["words"][c].T + w["word_bias"][c])[np.arange(b - a), targets[a:b] % per])
        out[order] = logs
        return out

    def learn(self, windows, targets):
        w, per, n = self.weights, self.shape.per_class, len(targets)
        _, windows, targets, hidden, runs = self.split(windows, targets)
        top = self.softmax(hidden @ w["classes"].T + w["class_bias"])
        top[np.arange(n), targets // per] -= 1
        back = top @ w["classes"]
        self._step("classes", top.T @ hidden / n)
        self._step("class_bias", top.mean(0))
        words, bias = np.zeros_like(w["words"]), np.zeros_like(w["word_bias"])
        for c, a, b in runs:
            low = self.softmax(hidden[a:b] @ w["words"][c].T + w["word_bias"][c])
            low[np.arange(b - a), targets[a:b] % per] -= 1
            back[a:b] += low @ w["words"][c]
            words[c], bias[c] = low.T @ hidden[a:b] / n, low.sum(0) / n
        self._step("words", words)
        self._step("word_bias", bias)
        back *= (1 - hidden * hidden) / n
        self._step("bias", back.sum(0))
        for k in range(windows.shape[1]):
            by = np.argsort(windows[:, k].astype(np.uint16), kind="stable")
            names = windows[by, k]
            heads = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
            self._step("context", np.add.reduceat(back[by], heads), (k, names[heads]))


def test_network_costs_less_than_row_by_row_and_is_the_same():
    shape = lm.Shape().grown(400_000)
    draw = np.random.default_rng(5)
    names = np.minimum(draw.zipf(1.2, (12, shape.batch, 5)), shape.vocabulary - 1)
    took = {}
    networks = [kind(shape).begin_as_unigram(np.bincount(names.ravel())) for kind in (lm.Network, RowByRow)]
    for network in networks:
        spent = took[type(network)] = ([], [])
        for batch in names:
            for times, work in zip(spent, (network.learn, network.log_probabilities)):
                began = time.thread_time()
                work(batch[:, 1:], batch[:, 0])
                times.append(time.thread_time() - began)
    ours, plain = networks
    logs = [n.log_probabilities(names[0][:, 1:], names[0][:, 0]) for n in networks]
    assert abs(float(logs[0].mean()) - float(logs[1].mean())) < 1e-3 and np.abs(logs[0] - logs[1]).mean() < 1e-2
    assert all(min(a) < 0.85 * min(b) for a, b in zip(took[lm.Network], took[RowByRow]))


def test_names_and_words_of_bytes():
    draw = np.random.default_rng(6)
    known = np.unique(draw.integers(0, 2**64, 900, np.uint64))
    known = np.concatenate([known, known[:40] + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])  # neighbours share their leading bits
    draw.shuffle(known)
    asked = np.concatenate([known, known + np.uint64(2), draw.integers(0, 2**64, 500, np.uint64)])
    for words in (known, known[:1], known[:0], np.arange(1000, dtype=np.uint64)):
        names, ids = lm.Names(words, SMALL), {int(w): i + 1 for i, w in enumerate(words)}
        shared = 1 + SMALL.common + lm._shared(asked, SMALL)
        assert names.of(asked, asked).tolist() == [ids.get(int(h), int(e)) for h, e in zip(asked, shared)]
    texts = [b"", b"ab c", b"", b" ", b"d", b"e  f\n", b"", "é\x0b g".encode(), b""]
    data, borders = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    rows, starts, ends = lm.words_of(data, borders)
    assert [(r, data[a:b].tobytes()) for r, a, b in zip(rows.tolist(), starts, ends)] == [(i, w) for i, t in enumerate(texts) for w in t.split()]
    assert lm.words_of(data[:0], np.array([0, 0]))[0].tolist() == []
    assert (lm.Hashes(data, 1).spans(starts, ends) == lm.Hashes(data.astype(np.int64), 1).spans(starts, ends)).all()


def test_untrained_network_is_the_unigram():
    times = np.arange(1 + SMALL.common + SMALL.endings, dtype=float)
    network = lm.Network(SMALL).begin_as_unigram(times)
    network.weights |= {k: np.zeros_like(network.weights[k]) for k in ("classes", "words")}
    logs = network.log_probabilities(np.zeros((len(times), 4), int), np.arange(len(times)))
    assert np.abs(np.exp(logs) - (times + 0.5) / (times.sum() + 0.5 * SMALL.vocabulary)).max() < 1e-6


def test_network_gives_a_distribution():
    network = lm.Network(SMALL)
    n = SMALL.vocabulary
    windows = np.repeat(np.array([[1, 2, 3, 4]]), n, 0)
    assert abs(np.exp(network.log_probabilities(windows, np.arange(n))).sum() - 1) < 1e-4


def test_pseudo_likelihood_predicts_words_that_share_a_name(spark):
    draw = random.Random(4)
    common = [f"w{i}" for i in range(40)]
    shape = lm.Shape(common=40, endings=1, per_class=13, width=8, batch=256, blocks=3)
    rows = [(i, " ".join([*draw.choices(common, k=30), *["kazmation"] * (i < 20)])) for i in range(90)]
    rows += [(i, "w1 w2 w3 kazmation w4 w5 w6") for i in (100, 101)] + [(102, "w1 w2 w3 qqqmation w4 w5 w6"), (103, None)]
    scored = {r.doc_id: r.log_likelihood for r in lm.pseudo_likelihood(frame(spark, rows), shape).collect()}
    assert len(scored) == len(rows) and scored[103] == 0
    known, once = lm.within_name(np.array([22, 1]))
    assert abs(scored[100] - scored[101]) < 1e-4 and abs(scored[100] - scored[102] - (known - once)) < 1e-4


def test_words_of_a_shared_name_are_a_distribution():
    times = np.array([7, 3, 1, 1])
    known, unseen = np.exp(lm.within_name(times) - lm.name_total(times.sum())), np.exp(lm.within_name(np.zeros(5, int)) - lm.name_total(times.sum()))
    assert abs(known.sum() + unseen.sum() - 1) < 1e-12 and unseen[0] < known.min()
    assert lm.Shape().grown(404_216).common > lm.Shape().common and lm.Shape().grown(10) == lm.Shape()
