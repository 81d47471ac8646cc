"""Part of tributary."""
