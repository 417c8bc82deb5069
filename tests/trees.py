"""Small file trees written by the tests."""

import json
import struct
import zlib
from pathlib import Path


def write(path: Path, content) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    if isinstance(content, bytes):
        path.write_bytes(content)
    else:
        path.write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")


def statements(root: Path) -> Path:
    def line(*fields):
        return "\t".join(fields) + "\n"

    full = ("1.json", "half-true", "He said 5 times \"no\" at www.x.org", "tax", "ann", "senator", "Ohio", "none", "1", "2", "3", "4", "5", "a talk")
    write(root / "train.tsv", line(*full) + line("2.json", "true", '"Quoted ""text"" here"', "tax", "bob", "", "", "none", "", "", "", "", "", "N/A"))
    write(root / "valid.tsv", line("3.json", "pants-fire", '"Open quote', "a,b", "eve", "NULL", "x", "y", "0", "0", "0", "0", "2.0", "c") + line("4.json", "odd", "Next", "s", "p", "j", "i", "q", "0", "0", "0", "0", "0", "c"))
    write(root / "test.tsv", line("1.json", "false", "Again", "s", "p", "j", "i", "q", "0", "0", "0", "0", "0", "c"))
    write(root / "notes.txt", "not\tread\n")
    return root


def threads(root: Path) -> Path:
    tree = root / "all-rnr-annotated-threads"

    def thread(event, kind, name, source=None, reactions=(), annotation=None):
        base = tree / event / kind / name
        if source is not None:
            write(base / "source-tweets" / f"{name}.json", source)
        for i, r in enumerate(reactions):
            write(base / "reactions" / ("deep/" if i % 2 else "") / f"r{i:02d}.json", r)
        if annotation is not None:
            write(base / "annotation.json", annotation)

    full = {
        "id_str": "1", "text": "Breaking: 3 hurt http://t.co/x", "created_at": "Mon", "lang": "en", "retweet_count": 7, "favorite_count": None,
        "user": {"id_str": "u1", "screen_name": "s", "verified": True, "followers_count": 9},
        "entities": {"urls": [{"expanded_url": "https://e.org"}, {"url": "u"}], "hashtags": [{"text": "h"}, {"n": 1}], "media": None},
    }
    replies = [{"text": f"reply {i}"} if i != 3 else {"id_str": "x"} for i in range(12)]
    thread("ev one", "rumours", "10", full, replies, {"misinformation": "0", "true": "1"})
    thread("ev one", "rumours", "11", {"text": None}, ["{broken", {"text": "ok"}], {"misinformation": 1})
    thread("ev one", "rumours", "12", {"id_str": "no text"}, [{"text": "a"}])
    thread("ev one", "rumours", "13", "{broken", [], {"misinformation": 0, "true": 0})
    thread("ev one", "rumours", "14", None, [{"text": "a"}])
    thread("ev one", "rumours", "15", {"text": "both"}, [], {"misinformation": 1, "true": 1})
    thread("ev one", "rumours", "16", {"text": "bare"})
    thread("ev one", "non-rumours", "10", {"text": "fact"}, [{"text": "x"}], {"misinformation": 1})
    thread("ev2", "non-rumours", "20", {"text": "fact two"})
    thread("ev2", "rumours", "21", {"text": "second"})
    write(tree / "ev2" / "rumours" / "21" / "source-tweets" / "0first.json", {"text": "first"})
    return root


def articles(root: Path) -> Path:
    def article(source, label, name, content, tweets=0):
        write(root / source / label / name / "news content.json", content)
        for i in range(tweets):
            write(root / source / label / name / "tweets" / f"{i}.json", {})

    article("gossipcop", "fake", "g-1", {"title": "T", "text": "Body 12 & more", "url": "http://x.org/a", "publish_date": 1234, "authors": ["A", "B"],
            "images": ["http://x.org/1.png", "http://x.org/1.png"], "image": "http://x.org/2.png", "keywords": ["k"], "meta_description": "d"}, 3)
    article("gossipcop", "real", "g-2", {"title": "Only", "text": "", "meta_description": "desc", "authors": "Solo", "images": "no list", "image": ""})
    article("politifact", "fake", "p-1", {"title": "Title", "authors": None})
    article("politifact", "fake", "p-2", {"text": "", "meta_description": "lost"})
    article("politifact", "fake", "p-3", "{broken")
    article("politifact", "fake", "p-4", {})
    article("politifact", "real", "p-5", {"text": "<p>Hi <b>there</b></p><img src=\"http://x.org/in.png\">", "title": None, "meta_description": None, "image": {"u": 1}}, 1)
    article("elsewhere", "fake", "e-1", {"text": "ignored"})
    article("politifact", "other", "o-1", {"text": "ignored"})
    write(root / "politifact" / "fake" / "p-1" / "notes.json", {})
    return root


def png(width: int, height: int, rows: bytes, alpha: bool = False) -> bytes:
    """PNG file of RGB or RGBA bytes."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    step = width * (4 if alpha else 3)
    raw = b"".join(b"\0" + rows[i * step : (i + 1) * step] for i in range(height))
    header = struct.pack(">IIBBBBB", width, height, 8, 6 if alpha else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def jpeg_with_tags(order: str) -> bytes:
    """JPEG header with Make, Software, a detail directory with the date, and a GPS pointer."""
    end = {"big": ">", "little": "<"}[order]
    make, soft, date = b"Cam\0", b"Editor 1.0\0", b"2020:01:02 03:04:05\0"
    at = 8 + 2 + 4 * 12 + 4
    soft_at, detail_at = at, at + len(soft)
    date_at = detail_at + 2 + 12 + 4

    def entry(tag, kind, count, value):
        return struct.pack(end + "HHI", tag, kind, count) + (value if isinstance(value, bytes) else struct.pack(end + "I", value))

    entries = [entry(0x010F, 2, len(make), make), entry(0x0131, 2, len(soft), soft_at), entry(0x8769, 4, 1, detail_at), entry(0x8825, 4, 1, 999)]
    tiff = (b"MM" if order == "big" else b"II") + struct.pack(end + "HI", 42, 8) + struct.pack(end + "H", 4) + b"".join(entries) + b"\0\0\0\0" + soft
    tiff += struct.pack(end + "H", 1) + entry(0x9003, 2, len(date), date_at) + b"\0\0\0\0" + date
    app = b"Exif\0\0" + tiff
    return b"\xff\xd8\xff\xe0\x00\x04JF\xff\xe1" + struct.pack(">H", len(app) + 2) + app + b"\xff\xda\x00\x02"


def images(root: Path) -> Path:
    red = png(4, 2, bytes([255, 0, 0]) * 8)
    write(root / "images" / "fake" / "i1.png", red)
    write(root / "images" / "fake" / "i1.jpg", b"not an image")
    write(root / "images" / "fake" / "i2.png", b"broken")
    write(root / "images" / "real" / "i3.png", png(3, 9, bytes([0, 0, 255, 128]) * 27, alpha=True))
    write(root / "images" / "real" / "i1.png", red)
    write(root / "images" / "real" / "i9.PNG", red)
    write(root / "set_images.txt", "i1\thttp://x/1\tFake\te1\n  i2\thttp://x/2\tfake\te1\nshort\tline\ni3\thttp://x/3\tREAL\te2\textra\ni4\thttp://x/4\treal\te2\ni9\tu\treal\te\ni5\tu\thumor\te\n")
    write(root / "tweets_images.txt", "t1\ti1\tfake\te1\nt2\ti1\tfake\te1\nt3\tzz\tfake\te1\nt4\ti3\n")
    return root


def article_images(root: Path) -> Path:
    base = root / "images" / "gossipcop" / "fake" / "g-1"
    write(base / "a.png", png(4, 2, bytes([1, 2, 3]) * 8))
    write(base / "b.png", b"broken")
    write(root / "metadata" / "list.json", [
        {"source": "gossipcop", "label": "fake", "article_id": "g-1", "image_count": 3, "images": ["a.png", "b.png", "gone.png"], "content_file": "c"},
        {"source": "gossipcop", "label": "fake", "article_id": "g-2", "images": []},
        {"source": "politifact", "label": "real", "article_id": "p-9"},
    ])
    return root
