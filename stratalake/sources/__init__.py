"""Where payloads come from and where layers are stored."""
