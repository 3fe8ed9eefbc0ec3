"""Where tables come from and where marts go."""
