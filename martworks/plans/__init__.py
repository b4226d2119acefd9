"""Plans of the retail lake: resource configs, staging, marts and the daily batch."""
