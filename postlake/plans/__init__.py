"""Jobs: extraction, view building, maintenance, export and the full cycle."""
