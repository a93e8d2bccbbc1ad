"""Where rows come from beside tables: fetched pages (http), search backends (backends), settings (settings), host frames (frames)."""
