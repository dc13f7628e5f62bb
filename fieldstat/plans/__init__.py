"""Census marts, report tables and data-quality datasets."""
