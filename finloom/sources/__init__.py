"""Row sources, table locations, volumes, value domains and declared contracts."""
