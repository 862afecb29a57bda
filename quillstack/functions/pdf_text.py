"""Plain text as a PDF file: standard fonts, one column, the same bytes for the same text."""

from __future__ import annotations

import textwrap

PAGE, EDGE, LEADING = (595, 842), 60, 1.4
#: Fixed-pitch standard fonts, so that the width of a line is known: 0.6 of the size for each character.
FONTS = {"plain": "Courier", "bold": "Courier-Bold", "slanted": "Courier-Oblique"}
PITCH = 0.6


def shown(text: str) -> bytes:
    """A string as a PDF literal in the usual Western encoding."""
    return b"(" + text.encode("cp1252", "replace").replace(b"\\", b"\\\\").replace(b"(", b"\\(").replace(b")", b"\\)") + b")"


def pages_of(lines: list[tuple[str, str, float]]) -> list[bytes]:
    """Content streams for lines (text, font, size), wrapped at the edges."""
    pages, now, y = [], [], PAGE[1] - EDGE
    for text, font, size in lines:
        for part in textwrap.wrap(text, int((PAGE[0] - 2 * EDGE) / (PITCH * size))) or [""]:
            if y < EDGE:
                pages.append(now)
                now, y = [], PAGE[1] - EDGE
            now.append(b"/%s %g Tf 1 0 0 1 %d %g Tm %s Tj" % (font.encode(), size, EDGE, round(y, 2), shown(part)))
            y -= size * LEADING
    return [b"BT\n" + b"\n".join(p) + b"\nET" for p in [*pages, now]]


def pdf(title: str, lines: list[tuple[str, str, float]]) -> bytes:
    """A PDF of lines (text, one of FONTS, size)."""
    streams = pages_of(lines)
    first = 4 + len(FONTS)  # catalogue, pages, information, fonts, then a page and its text in turn
    fonts = b" ".join(b"/%s %d 0 R" % (k.encode(), 4 + i) for i, k in enumerate(FONTS))
    kids = b" ".join(b"%d 0 R" % (first + 2 * i) for i in range(len(streams)))
    objects = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [%s] /Count %d >>" % (kids, len(streams)), b"<< /Title %s >>" % shown(title)]
    objects += [b"<< /Type /Font /Subtype /Type1 /BaseFont /%s /Encoding /WinAnsiEncoding >>" % name.encode() for name in FONTS.values()]
    for i, stream in enumerate(streams):
        objects.append(b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 %d %d] /Resources << /Font << %s >> >> /Contents %d 0 R >>" % (*PAGE, fonts, first + 2 * i + 1))
        objects.append(b"<< /Length %d >>\nstream\n%s\nendstream" % (len(stream), stream))
    out, places = b"%PDF-1.4\n", []
    for i, body in enumerate(objects, 1):
        places.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (i, body)
    table = b"".join(b"%010d 00000 n \n" % at for at in places)
    return out + b"xref\n0 %d\n0000000000 65535 f \n%strailer\n<< /Size %d /Root 1 0 R /Info 3 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (len(objects) + 1, table, len(objects) + 1, len(out))
