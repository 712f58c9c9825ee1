"""PDF files, where the library that reads them is installed."""

from __future__ import annotations

from ledgerloom.functions.text import TEXT_LAYER_CHARS

RENDER_DPI = 300


def parse_pdf(content: bytes, dpi: int = RENDER_DPI) -> list[tuple[str, list[dict]]]:
    """(text, images) of each page, for ``files.read_pages``.

    A page with a text layer gives its text only.  Any other gives its largest embedded picture as it was stored, in
    grey, or, where it has none that can be read, the page rendered.  Raises ``ImportError`` without ``pymupdf``.
    """
    import pymupdf

    def grey(picture: object) -> dict:
        if picture.colorspace is None or picture.colorspace.n != 1 or picture.alpha:
            picture = pymupdf.Pixmap(pymupdf.csGRAY, pymupdf.Pixmap(picture, 0) if picture.alpha else picture)
        return {"width": picture.width, "height": picture.height, "data": bytes(picture.samples)}

    def picture_of(doc: object, page: object) -> dict:
        # Entries are (reference, mask, width, height, ..); of equal areas the first is tried first.
        for info in sorted(page.get_images(full=True), key=lambda i: -i[2] * i[3]):
            try:
                return grey(pymupdf.Pixmap(doc, info[0]))
            except Exception:  # a picture that cannot be decoded leaves the next one
                continue
        return grey(page.get_pixmap(dpi=dpi))

    with pymupdf.open(stream=content, filetype="pdf") as doc:
        texts = [(page, page.get_text().strip()) for page in doc]
        return [(text, []) if len(text) >= TEXT_LAYER_CHARS else (text, [picture_of(doc, page)]) for page, text in texts]
