"""Structured Streaming forms of two batch operators (an extension; the
reference itself has no stream): hourly bins (A01) and gap sessions (W04)."""
