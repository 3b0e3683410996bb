"""Native column expressions shared by every operator."""
