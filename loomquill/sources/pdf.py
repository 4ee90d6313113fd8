"""Plain PDF files read at the level of bytes: the text of pages and embedded JPEG images, without any model.

What it reads: objects with and without object streams, pages in the order of the page tree, FlateDecode or plain content
streams, text operators with single-byte fonts. What it refuses with an error, so that a caller falls back: encryption, other
filters, and composite fonts, whose codes aren't characters.
"""

from __future__ import annotations

import re
import zlib

from loomquill.sources.extract import Extractor

OBJECT = re.compile(rb"(?<!\d)(\d+)\s+\d+\s+obj\b(.*?)\bendobj\b", re.S)
STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.S)
REFERENCE = re.compile(rb"(\d+)\s+\d+\s+R\b")
ITEM = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/<>\[\](){}%]+|[-+]?\d*\.?\d+|[A-Za-z'\"*]+|<<|>>", re.S)
ESCAPE = re.compile(rb"\\(?:([0-7]{1,3})|(\r\n|.))", re.S)
#: What follows a backslash in a string.
ESCAPED = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
#: A shift to the left by more than so many thousandths of the font's size is a blank between words.
GAP = 200


def _stream(body: bytes) -> bytes:
    found = STREAM.search(body)
    if not found:
        return b""
    head = body[: found.start()]
    filters = re.findall(rb"/(\w+Decode)\b", head)
    if not filters:
        return found.group(1)
    if filters != [b"FlateDecode"] or re.search(rb"/Predictor\s+(?!1\b)\d", head):
        raise ValueError(f"unread filter {filters[0].decode()}")
    return zlib.decompressobj().decompress(found.group(1))


def _objects(content: bytes) -> dict[int, bytes]:
    if not content.lstrip().startswith(b"%PDF"):
        raise ValueError("no PDF file")
    if re.search(rb"/Encrypt\b", content):
        raise ValueError("an encrypted file")
    found = {int(n): body for n, body in OBJECT.findall(content)}
    for body in list(found.values()):
        if re.search(rb"/Type\s*/ObjStm\b", body):
            packed, head = _stream(body), body
            first = int(re.search(rb"/First\s+(\d+)", head).group(1))
            places = [int(x) for x in packed[:first].split()]
            ends = [*places[3::2], len(packed) - first]
            for n, start, end in zip(places[::2], places[1::2], ends, strict=True):
                found.setdefault(n, packed[first + start : first + end])
    return found


def _entry(body: bytes, name: bytes) -> bytes:
    """The text after a name of a dictionary, up to the next one that isn't inside brackets."""
    at = re.search(rb"/" + name + rb"\b", body)
    if not at:
        return b""
    rest = body[at.end() :].lstrip()
    if rest.startswith(b"<<"):
        depth = 0
        for m in re.finditer(rb"<<|>>", rest):
            depth += 1 if m.group() == b"<<" else -1
            if not depth:
                return rest[: m.end()]
    if rest.startswith(b"["):
        return rest[: rest.find(b"]") + 1]
    return re.split(rb"/|>>", rest, maxsplit=1)[0]


def _resolved(objects: dict[int, bytes], value: bytes) -> bytes:
    found = REFERENCE.fullmatch(value.strip())
    return objects.get(int(found.group(1)), b"") if found else value


def _pages(objects: dict[int, bytes]) -> list[bytes]:
    """Page dictionaries in order."""
    roots = [n for n, b in objects.items() if re.search(rb"/Type\s*/Pages\b", b) and not re.search(rb"/Parent\b", b)]
    out: list[bytes] = []
    waiting, seen = list(reversed(roots)), set()
    while waiting:
        n = waiting.pop()
        body = objects.get(n, b"")
        if n in seen:
            continue
        seen.add(n)
        if re.search(rb"/Type\s*/Pages\b", body):
            waiting += [int(x) for x in reversed(REFERENCE.findall(_entry(body, b"Kids")))]
        elif re.search(rb"/Type\s*/Page\b", body):
            out.append(body)
    return out


def _decoded(token: bytes) -> str:
    if token.startswith(b"<"):
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        raw = ESCAPE.sub(lambda m: bytes([int(m.group(1), 8) & 255]) if m.group(1) else ESCAPED.get(m.group(2), b"" if m.group(2) in (b"\n", b"\r", b"\r\n") else m.group(2)), token[1:-1])
    if raw.startswith(b"\xfe\xff"):
        return raw[2:].decode("utf-16-be", "replace")
    return raw.decode("cp1252", "replace")


def _shown(stream: bytes) -> str:
    """The text that a content stream shows, a line for each new line position."""
    out: list[str] = []
    held: list[bytes] = []
    line = None
    for token in ITEM.findall(stream):
        if not re.fullmatch(rb"[A-Za-z'\"*]+", token):
            held.append(token)
            continue
        numbers = [float(x) for x in held if re.fullmatch(rb"[-+]?\d*\.?\d+", x)]
        moved = token == b"T*" or token in (b"'", b'"') or token in (b"Td", b"TD") and len(numbers) >= 2 and numbers[-1] != 0
        if token == b"Tm" and len(numbers) >= 6:
            moved, line = line is not None and numbers[-1] != line, numbers[-1]
        if moved and out and out[-1] != "\n":
            out.append("\n")
        elif token in (b"Td", b"TD", b"Tm") and out and out[-1] not in ("\n", " "):
            out.append(" ")
        if token in (b"Tj", b"TJ", b"'", b'"'):
            for x in held:
                if x[:1] in b"(<" and x not in (b"<<", b">>"):
                    out.append(_decoded(x))
                elif token == b"TJ" and re.fullmatch(rb"-\d*\.?\d+", x) and -float(x) > GAP:
                    out.append(" ")
        held = []
    return "\n".join(x.rstrip() for x in "".join(out).split("\n")).strip()


class PlainPdf(Extractor):
    """An extractor for plain PDF files; tables, captions, charts and text in images are left to models."""

    def pages(self, content: bytes) -> list[str]:
        objects = _objects(content)
        out = []
        for page in _pages(objects):
            fonts = _resolved(objects, _entry(_resolved(objects, _entry(page, b"Resources")), b"Font"))
            if any(re.search(rb"/Subtype\s*/Type0\b", objects.get(int(n), b"")) for n in REFERENCE.findall(fonts)):
                raise ValueError("a composite font")
            parts = [int(n) for n in REFERENCE.findall(_entry(page, b"Contents"))]
            bodies = [objects.get(n, b"") for n in parts]
            # an indirect array of streams
            bodies = [objects.get(int(m), b"") for b in bodies for m in REFERENCE.findall(b)] if bodies and b"stream" not in bodies[0] else bodies
            out.append(_shown(b"\n".join(_stream(b) for b in bodies)))
        return out

    def whole(self, content: bytes) -> str:
        """The strings that any readable content stream shows; '' if there is none."""
        found = []
        for _, body in OBJECT.findall(content):
            try:
                found.append(_shown(_stream(body)) if b"stream" in body and not re.search(rb"/(?:Subtype|Type)\b", body) else "")
            except (ValueError, zlib.error):
                continue
        return "\n".join(x for x in found if x)

    def images(self, content: bytes) -> list[dict]:
        """JPEG images of the pages, with their bytes."""
        objects = _objects(content)
        out = []
        for number, page in enumerate(_pages(objects), 1):
            drawn = _resolved(objects, _entry(_resolved(objects, _entry(page, b"Resources")), b"XObject"))
            for n in (int(x) for x in REFERENCE.findall(drawn)):
                body = objects.get(n, b"")
                head, data = body.partition(b"stream")[0], STREAM.search(body)
                if data and re.search(rb"/Subtype\s*/Image\b", head) and re.findall(rb"/(\w+Decode)\b", head) == [b"DCTDecode"]:
                    size = [int(re.search(rb"/" + k + rb"\s+(\d+)", head).group(1)) for k in (b"Width", b"Height")]
                    spans = " ".join(t for t, conf in self.spans(data.group(1)) if conf is None or conf >= 0.3)
                    out.append({"page": number, "xref": n, "rect": "0", "width": size[0], "height": size[1], "ocr": spans, "vision_label": None, "content": data.group(1)})
        return out
