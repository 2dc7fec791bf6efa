"""Readers: file listings, headered CSV, NDJSON, raw documents and message envelopes."""
