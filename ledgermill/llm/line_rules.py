"""Quality rules, line first: failing lines are removed, then documents that lose too much text are rejected.

Each line is judged on its own by its bytes:

- symbols: more than `symbol_share` of its words' bytes are symbols `# * $ % & | < >`;
- navigation: it has two or more separators (`|`, `>` or `»` between white space) with at most four other words to each
  item, or up to `menu_words` words without closing punctuation between longer text;
- shouting: most of its letters A-Z are capitals, over at least three words;
- stutter: more than half of its words repeat the word before them in the line;
- boilerplate: it has at most `furniture_words` words and holds one of BOILERPLATE.

A document is rejected if it fails the base rules (under 20 words, or more than 30 % of its words in 8-word windows
that occur twice), or if failing lines hold more than `most_lost` of its words.

Defined results: NULL and empty texts have no words and are rejected by the base rules; rows with the same id are judged
one by one; NULL ids stay NULL; other columns are neither read nor returned (`carry` passes them on unchanged).
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import common

#: Phrases of page furniture, searched without regard to case A-Z.
BOILERPLATE = (
    b"all rights reserved",
    b"cookie policy",
    b"privacy policy",
    b"terms of use",
    b"terms of service",
    b"click here",
    b"enable javascript",
    b"sign up for our newsletter",
    b"skip to content",
    b"share on facebook",
    b"powered by",
    b"lorem ipsum",
)
RESULT = """n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,
    n_failed_words bigint, base_failed boolean, kept boolean"""

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CLOSING = np.zeros(256, dtype=bool)
_CLOSING[list(b".!?\"':;,)]")] = True
_SEPARATORS = np.concatenate(
    [common.span_hashes(np.frombuffer(x, dtype=np.uint8), np.array([0]), np.array([len(x)])) for x in (b"|", b">", b"\xc2\xbb")]
)


def _judge(
    batches: Iterator[pa.RecordBatch],
    carry: Sequence[str],
    with_text: bool,
    symbol_share: float,
    menu_words: int,
    furniture_words: int,
    most_lost: float,
) -> Iterator[pa.RecordBatch]:
    for batch, texts in common.row_blocks(batches):
        data, bounds = texts
        words = common.words_of(texts)
        hashes = common.span_hashes(data, words.starts, words.ends)
        n_words = np.diff(words.first)
        n_symbols = common.between(_SYMBOL[data], bounds[:-1], bounds[1:])
        letters = common.inked(data)
        word_chars = common.between(letters, bounds[:-1], bounds[1:])
        starts, ends, owner = common.lines_of(texts)
        line_words = np.searchsorted(words.starts, ends) - np.searchsorted(words.starts, starts)
        line_hash = common.span_hashes(data, starts, ends)
        filled = line_words > 0
        symbols = common.between(_SYMBOL[data], starts, ends)
        inked = common.between(letters, starts, ends)
        capitals = common.between((data >= 65) & (data <= 90), starts, ends)
        smalls = common.between((data >= 97) & (data <= 122), starts, ends)
        own_words = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
        bars = common.between(np.isin(hashes, _SEPARATORS), *own_words)
        echo = np.zeros(len(hashes) + 1, dtype=bool)
        echo[1:-1] = hashes[1:] == hashes[:-1]
        echo[own_words[0]] = False
        echoes = common.between(echo, *own_words)
        last = words.ends[np.maximum(np.searchsorted(words.starts, ends) - 1, 0)] - 1 if len(words.ends) else starts
        closed = _CLOSING[data[last]] if len(data) else np.zeros(0, dtype=bool)
        failed = filled & (
            (symbols > symbol_share * np.maximum(inked, 1))
            | ((bars >= 2) & (line_words - bars <= 4 * (bars + 1)))
            | ((line_words <= menu_words) & ~closed & (n_words[owner] > 4 * menu_words))
            | ((line_words >= 3) & (capitals > 2 * smalls))
            | ((line_words >= 3) & (2 * echoes > line_words))
        )
        low = texts.lower().data.tobytes()
        for phrase in BOILERPLATE:
            at = low.find(phrase)
            while at >= 0:
                line = np.searchsorted(starts, at, side="right") - 1
                failed[line] |= line_words[line] <= furniture_words
                at = low.find(phrase, at + 1)
        lost = np.zeros(len(n_words), dtype=np.int64)
        np.add.at(lost, owner[failed], line_words[failed])
        n_dup, n_repeat, cleaned = [], [], []
        line_first = np.searchsorted(owner, np.arange(len(n_words) + 1))
        for i in range(len(n_words)):
            lines = slice(line_first[i], line_first[i + 1])
            own = line_hash[lines][filled[lines]]
            n_dup.append(len(own) - len(np.unique(own)) if len(own) > 1 else 0)
            n_repeat.append(common.repeat_words(hashes[words.first[i] : words.first[i + 1]], 8))
            if with_text:
                if not failed[lines].any():
                    cleaned.append(texts.text(i))
                else:
                    at = zip(starts[lines].tolist(), ends[lines].tolist(), failed[lines].tolist(), strict=True)
                    cleaned.append(b"\n".join(data[s:e].tobytes() for s, e, bad in at if not bad))
        n_dup, n_repeat = np.array(n_dup, dtype=np.int64), np.array(n_repeat, dtype=np.int64)
        base = (n_words < 20) | (100 * n_repeat > 30 * n_words)
        out = [batch.column(name) for name in carry]
        if with_text:
            out.append(pa.array(cleaned, type=pa.binary()).cast(pa.string()))
        out += [pa.array(x.astype(np.int64)) for x in (n_words, word_chars, n_symbols, n_dup, n_repeat, lost)]
        out += [pa.array(base), pa.array(~base & (lost <= most_lost * n_words))]
        yield pa.RecordBatch.from_arrays(out, names=[str(i) for i in range(len(out))])


def line_quality(
    docs: DataFrame,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    with_text: bool = False,
    symbol_share: float = 0.1,
    menu_words: int = 2,
    furniture_words: int = 20,
    most_lost: float = 0.4,
) -> DataFrame:
    """One row per document: the columns of `carry`, `clean_text` if `with_text`, and RESULT. One narrow pass."""
    source = docs.select(*[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(carry)], F.col(text).alias("text"))
    kept = [f"c{i}" for i in range(len(carry))]
    kinds = ", ".join(f"{name} {kind}" for name, kind in source.dtypes if name != "text")
    schema = f"{kinds}, {'clean_text string, ' if with_text else ''}{RESULT}"
    out = common.map_arrow(
        source, lambda batches: _judge(batches, kept, with_text, symbol_share, menu_words, furniture_words, most_lost), schema
    )
    return out.toDF(*carry, *out.columns[len(carry) :])
