"""Token counts by prefix dynamic programming.

A tokenizer whose pre-tokeniser never joins across white space gives every prefix of a text that ends
at white space the tokens of its pieces, piece by piece. So count[prefix i] = count[prefix i-1] +
tokens(piece i): one pass over the pieces fills the table for every such prefix, and a prefix that ends
inside a piece costs one more look-up, of that part of the piece. Truncation and budget questions are
answered from the table; no text is encoded twice, and a piece that recurs is not encoded again.

Null and empty texts have no pieces and 0 tokens. Repeated rows give repeated results. Only the two
named columns are read. Memory: one slice of texts (8 MiB or one text) and a bounded cache of pieces.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession

from . import common

PIECE = re.compile(common.WORD)
CACHE = 400_000


class PrefixCounter:
    """Exact token counts of prefixes of texts; one per Python worker."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        if not os.path.isabs(tokenizer):
            import public_tokenizers

            tokenizer = public_tokenizers.path(tokenizer)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, int] = {}

    def learn(self, pieces: set[bytes]) -> None:
        if len(self.known) > CACHE:
            self.known.clear()
        new = [p for p in pieces if p not in self.known]
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            found = self.tokenizer.encode_batch_fast([p.decode("utf-8") for p in part], add_special_tokens=False)
            self.known.update(zip(part, map(len, found), strict=True))

    def tables(self, texts: list[bytes]) -> list[list[int]]:
        """For each text the token count of every prefix that ends with a piece."""
        import numpy as np

        split = [t.split() for t in texts]  # bytes.split() knows the six ASCII characters only
        self.learn({p for s in split for p in s})
        get = self.known.__getitem__
        return [np.fromiter(map(get, s), np.int64, len(s)).cumsum() for s in split]

    def prefix(self, text: str, n_chars: int) -> int:
        """Tokens of text[:n_chars], from the table and one look-up."""
        table = self.tables([text.encode()])[0]
        spans = [m.span() for m in PIECE.finditer(text)]
        k = bisect_right([e for _, e in spans], n_chars)
        count = int(table[k - 1]) if k else 0
        if k < len(spans) and spans[k][0] < n_chars:
            part = text[spans[k][0] : n_chars].encode()
            self.learn({part})
            count += self.known[part]
        return count

    def fit(self, text: bytes, table, budget: int) -> int:
        """Code points of the longest prefix of whole pieces with at most budget tokens."""
        k = int(table.searchsorted(budget, "right"))
        if k == len(table):
            return len(text.decode("utf-8"))
        return next((m.end() for i, m in enumerate(PIECE.finditer(text.decode("utf-8"))) if i == k - 1), 0)


def prefix_counts(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", id_col: str = "doc_id", text_col: str = "text", budget: int = 2048, with_tables: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars (where the text can be cut so that budget tokens
    suffice, whole pieces only); with_tables: also prefix_tokens, the count at the end of every piece."""
    common.shared_dir(docs.sparkSession)
    rows = common.pick(docs, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        counter = PrefixCounter(tokenizer)
        for piece in common.pieces(batches):
            texts = common.encoded(piece.column("text"))
            tables = counter.tables(texts)
            counts = [int(t[-1]) if len(t) else 0 for t in tables]
            out = {"doc_id": piece.column("id"), "n_bytes": pa.array([len(t) for t in texts], pa.int64()), "n_tokens": pa.array(counts, pa.int64()), "over_limit": pa.array([c > budget for c in counts], pa.bool_()), "fit_chars": pa.array([counter.fit(x, t, budget) for x, t in zip(texts, tables, strict=True)], pa.int64())}
            if with_tables:
                out["prefix_tokens"] = pa.array([t.tolist() for t in tables], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(out)

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long" + ", prefix_tokens array<long>" * with_tables)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: every document's exact token count under word_bpe_49k.json and whether it exceeds 2048."""
    return prefix_counts(common.table(spark, sf_dir, "documents"))
