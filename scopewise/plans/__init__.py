"""Whole jobs: processed outputs, bundles, releases and their verification."""
