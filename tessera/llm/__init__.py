"""Operators of a training-data pipeline (mixing, packing, token counts, chat
formatting, language-model scoring, nearest neighbours, URL filters, near and
substring deduplication, quality rules).  Nothing else in the library imports
this subpackage."""
