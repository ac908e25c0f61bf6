"""Writers (SNK-*)."""
