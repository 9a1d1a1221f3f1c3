"""Line-first cleaning: punctuation, navigation and boilerplate rules judge every line, failing lines go, then texts that lost too much go.

All work is by row, so there is no shuffle; a task holds a slice of rows at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column, need, words_of

SYMBOLS = "#*$%&|<>"
#: Ends of a sentence, before closing quotes and brackets.
TERMINAL = re.compile(r"[.!?:;…。！？][\"'”’»)\]]*$")
#: Phrases of page furniture in English, French, German and Spanish, in lower case.
BOILERPLATE = re.compile(
    r"lorem ipsum|enable javascript|javascript is (?:disabled|required)|accept (?:all )?cookies|cookie (?:policy|settings|consent)|privacy policy|terms (?:of (?:use|service)|and conditions)"
    r"|all rights reserved|click here|read more|sign (?:in|up)\b|log ?in\b|subscribe (?:now|to our)|add to cart|share on (?:facebook|twitter|x)|skip to (?:main )?content|back to top"
    r"|tous droits réservés|politique de confidentialité|mentions légales|conditions (?:générales )?d['’]utilisation|accepter (?:tous )?les cookies|cliquez ici|lire la suite|ajouter au panier|retour en haut|aller au contenu|partager sur (?:facebook|twitter|x)\b"
    r"|alle rechte vorbehalten|datenschutzerklärung|nutzungsbedingungen|allgemeine geschäftsbedingungen|cookies akzeptieren|klicken sie hier|hier klicken|weiterlesen\b|jetzt anmelden|in den warenkorb|zurück nach oben|zum inhalt springen|newsletter abonnieren"
    r"|todos los derechos reservados|política de (?:privacidad|cookies)|términos (?:y condiciones|de uso)|aviso legal|aceptar (?:todas )?(?:las )?cookies|ha(?:ga|z) clic aquí|leer más\b|iniciar sesión|añadir al carrito|volver arriba|saltar al contenido"
)
SEPARATORS = re.compile(r"(?:^|\s)[|>»•·/](?=\s|$)")
NOISE = re.compile(r"[^\w\s.,;:?'\"()\-–—’“”«»¿¡…]")
PAUSE = re.compile(r"[.,;:!?…。！？]")
#: How often a line may be in one text before it counts as page furniture.
FURNITURE = 3
LINE_RULES = ("navigation", "noise", "boilerplate", "unpunctuated", "fragment")


def judge_line(line: str, n_words: int) -> str | None:
    """The first rule of ``LINE_RULES`` that a line with words fails, or None.

    navigation: two or more lone separators, one for every four words at least. noise: more than one odd
    symbol for every two words. boilerplate: a known phrase for every thirty words at least. unpunctuated: more than
    thirty words without one pause or end. fragment: at most three words without a sentence's end.
    """
    seps = len(SEPARATORS.findall(line))
    if seps >= 2 and 4 * seps >= n_words:
        return "navigation"
    if len(NOISE.findall(line)) * 2 > n_words + 2:
        return "noise"
    if 30 * len(BOILERPLATE.findall(line.lower())) >= n_words:
        return "boilerplate"
    if n_words > 30 and not PAUSE.search(line):
        return "unpunctuated"
    if n_words <= 3 and not TERMINAL.search(line.rstrip()):
        return "fragment"
    return None


def is_open(line: str, n_words: int) -> bool:
    """A short line of more than three words without a sentence's end; ``clean`` takes such lines where they are most of a text."""
    return 3 < n_words <= 8 and not TERMINAL.search(line.rstrip())


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that are found twice or more."""
    if len(words) <= width:
        return 0
    known: dict[bytes, int] = {}
    code = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    n = len(words) - width + 1
    window = code[:n]
    for k in range(1, width):
        window = window * len(known) + code[k : k + n]
        if len(known) ** (k + 2) >= 2**62:
            window = np.unique(window, return_inverse=True)[1].astype(np.int64)
    _, at, count = np.unique(window, return_inverse=True, return_counts=True)
    hit = np.concatenate(([0], np.cumsum(count[at] > 1)))
    i = np.arange(len(words))
    return int((hit[np.minimum(i + 1, n)] > hit[np.maximum(i - width + 1, 0)]).sum())


def clean(text: str | None) -> dict:
    """Counts, the lines kept, and the verdict on one text.

    Two rules need the whole text: a line found ``FURNITURE`` times in it is furniture (boilerplate), and short lines without
    an end (``is_open``) that are most of its lines are a menu (fragment).
    """
    text = text or ""
    words = words_of(text)
    seen, n_dup, kept, lost = set(), 0, [], dict.fromkeys(LINE_RULES, 0)
    chars = kept_chars = 0
    lines = [(line, words_of(line)) for line in text.split("\n")]
    often = {x for x, n in Counter(line.strip() for line, own in lines if own).items() if n >= FURNITURE}
    n_open = sum(is_open(line, len(own)) for line, own in lines)
    menu = n_open >= 3 and 2 * n_open > sum(bool(own) for _, own in lines)
    for line, own in lines:
        if not own:
            kept.append(line)
            continue
        n_dup += line in seen
        seen.add(line)
        size = sum(map(len, own))
        chars += size
        rule = judge_line(line, len(own)) or ("boilerplate" if line.strip() in often else "fragment" if menu and is_open(line, len(own)) else None)
        if rule:
            lost[rule] += 1
        else:
            kept_chars += size
            kept.append(line)
    n_repeat = repeated_words(words)
    blanks = sum(map(text.count, " \t\n\x0b\x0c\r"))
    failed = len(words) < 50 or 100 * n_repeat > 50 * len(words)
    return {
        "n_words": len(words),
        "word_chars": len(text) - blanks,
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": n_dup,
        "n_repeat_words": n_repeat,
        "base_failed": failed,
        "kept": not failed and kept_chars * 2 >= chars,
        "kept_share": kept_chars / chars if chars else 0.0,
        "clean_text": "\n".join(kept),
        **{f"lost_{k}": v for k, v in lost.items()},
    }


SCHEMA = {
    **{k: "long" for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")},
    "base_failed": "boolean", "kept": "boolean", "kept_share": "double", "clean_text": "string", **{f"lost_{k}": "long" for k in LINE_RULES},
}
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}


def quality_rules(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id and the columns of ``SCHEMA`` for every row of ``docs`` (doc_id, text).

    A null text has no words and fails. Rows that repeat, and null ids, are rows of their own. An empty table
    gives no rows. Other columns are not returned.
    """
    need(docs, "doc_id", "text")
    out = {k: v for k, v in SCHEMA.items() if with_text or k != "clean_text"}

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = batch.slice(at, 1000)
                made = [clean(t.as_py()) for t in rows.column(1)]
                yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array([m[k] for m in made], _ARROW[v]) for k, v in out.items())], ["doc_id", *out])

    return docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").alias("text")).mapInArrow(part, "doc_id long, " + ", ".join(f"{k} {v}" for k, v in out.items()))
