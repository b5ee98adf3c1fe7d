"""Where listings come from and where raw ones are kept."""
