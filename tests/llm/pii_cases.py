"""Texts with marked personal information, written by hand apart from the tables' wording: [kind:text] marks an item."""

CASES = """
Her SSN is [id_number:123-45-6789] and her old badge was 4411.
Please have [name:Peter Novak] repeat the measurement.
[name:Robert Jones] left the lab at noon; [name:Samantha Keller] stayed.
Yesterday [name:Maria Gonzalez] and [name:Thomas Weber] met in room 12.
Send the sample to [address:1600 Pennsylvania Avenue NW, Washington, DC 20500] before Friday.
Reach the front desk on [phone:0207 946 0958] or at [email:desk@museum.example].
The proxy is http://user:secret@host.example/path and needs no change.
git clone ssh://git@code.example/repo.git fetched 12 objects.
Mail [email:first.last+tag@sub.domain.example] for access.
His address is [email:j_doe at mailbox dot example].
Write to [email:sales[at]shop.example] today.
Call [phone:+49 89 1234567] between 9 and 5.
My number: [phone:(415) 555-2671].
Our fax is [phone:212-555-0175], extension 3.
Tel. [phone:+33 6 12 34 56 78] (mobile).
Llama al [phone:612 345 678] por la tarde.
Sein Anschluss ist [phone:0351/4567890].
Payment from IBAN [id_number:DE89 3704 0044 0532 0130 00] arrived.
Card [id_number:4111 1111 1111 1111] was declined.
The order 4111 1111 1111 1112 shipped.
Version 12345678A of the tool is broken.
DNI [id_number:12345678Z] caducado.
El titular con DNI [id_number:87654321-X] firmó.
Numéro de sécurité sociale : [id_number:1 84 12 76 451 089 46].
National insurance number [id_number:AB123456C] on file.
Commit 1234567890abcdef fixed it.
Part no. 212-44-9516 replaces 212-44-9517.
Dr. [name:Ingrid Sorensen] approved the plan.
Mrs. [name:O'Connor-Smith], we could not reach you.
Sincerely,\\n-- \\n[name:Karl Lindqvist]\\n[phone:+1 303 555 0142]
Reviewer: [name:Wei Zhang]
Assigned to: [name:Priya Raman]
[name:Torvald Brakstad] said the fuse was blown.
Comme [name:Aurélien Vasseur] a écrit, le bloc reste actif.
Wie [name:Jörg Petersen] schrieb, bleibt der Takt gleich.
Según [name:Pablo Ferrer], todo funciona.
Livrer au [address:12 rue de la Paix, 75002 Paris] demain.
Lieferung an [address:Hauptstraße 5, 10115 Berlin] erbeten.
Enviar a [address:Calle Mayor 10, 28013 Madrid] hoy.
Ship to [address:221B Baker Street, London NW1 6XE] please.
Clock Tree will settle after Power Grid sign-off.
Global Timer reviewed against Table 4 on 2024-05-06 12:30:45.
Address 0x40021000 holds 16 registers; value 343-80-1884 is a part no. of ours.
Main Street Analyzer v2 reads 12 Lane Links.
The range 10.0.0.1-10.0.0.254 and 192.168.10.20 are private.
pkg@1.2.3 and HEAD@{2} are no mail; @(posedge clk) neither.
""".strip().split("\n")


def parsed():
    """(text, [(start, kind)]) of every case."""
    import re

    for line in CASES:
        line = line.replace("\\n", "\n")
        text, want, at = "", [], 0
        for m in re.finditer(r"\[(email|phone|id_number|address|name):((?:[^\[\]]|\[at\])*)\]", line):
            text += line[at : m.start()]
            want.append((len(text), m[1]))
            text += m[2]
            at = m.end()
        yield text + line[at:], want
