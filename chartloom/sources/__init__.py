"""Batch and streaming scans."""
