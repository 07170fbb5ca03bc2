"""Where tables come from and go to."""

from ratingloom.sources.csv_tables import read_items, read_ratings
from ratingloom.sources.exports import json_records, write_json_records
from ratingloom.sources.forms import parse_submissions
from ratingloom.sources.rejects import accepted, rejected
from ratingloom.sources.staging import read_staged, stage
from ratingloom.sources.uploads import parse_lines, read_uploads, upload_lines

__all__ = [
    "accepted", "json_records", "parse_lines", "parse_submissions", "read_items", "read_ratings",
    "read_staged", "read_uploads", "rejected", "stage", "upload_lines", "write_json_records",
]
