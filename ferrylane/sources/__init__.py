"""Where rows and catalogs come from."""
