"""Where rows come from and go to: text extracts, literal rows, stored tables, the catalog."""
