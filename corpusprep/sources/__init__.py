"""Sources and sinks: JSONL files, folders of per-language files, the
provider map, the article archive and the labelled store."""

from corpusprep.sources.jsonl import (
    LINE_STATUS_OK,
    parse_lines,
    read_jsonl,
    valid_records,
    write_jsonl,
)

__all__ = ["LINE_STATUS_OK", "parse_lines", "read_jsonl", "valid_records", "write_jsonl"]
