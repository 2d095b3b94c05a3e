"""Jobs wiring operators together: star schema builds, the wide view, reports."""
