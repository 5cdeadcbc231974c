"""Sources: CSV folders and document exports. Landed API pages are plain tables."""
