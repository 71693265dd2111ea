"""Sentences written by hand, on other matters than the test tables: the text, with what is personal in it marked as
{type:value}. Types: e email, p phone, i identity number, s street address, n name."""

SHEET = """
my landlord {n:Tunde Adeyemi} said so twice
I met {n:Xiomara Okonkwo} yesterday evening.
Please write to {n:Tunde Adeyemi} for details.
the plumber, {n:Anneliese Brandt}, came by on Friday
Yesterday {n:Ruben Castellano} fixed the boiler.
We hired {n:Ingeborg Lindahl} to paint the fence.
Minutes taken by {n:Priya Raghunathan}.
{n:Oskar Lindgren} and {n:Hanna Solberg} moved out in June.
Our coach is {n:Demetrius Whitlock}.
Dr. {n:Amara Nwosu} will see you at nine.
Ms {n:Leila Farahani} chairs the meeting.
Prof. {n:Giancarlo Bellini} retired.
A parcel for {n:Svetlana Morozova} is at the gate.
My cousin {n:Malik Jefferson} drives a truck.
Signed, {n:Theodora Papadakis}
Regards,\\n{n:Bartholomew Quigley}
— {n:Yusuf Karahan}
The house belongs to {n:Marguerite de la Fontaine}.
I spoke with {n:Juan van der Berg} about it.
The violin of {n:Sunniva Haugen} was stolen.
Is {n:Casimir Dudek} still your dentist?
{n:Beatriz Salgueiro} painted that wall.
Give the keys to {n:Farouk Haddad}, he knows.
{n:Nils P. Jorgensen} owes me a beer.
I think {n:Chidinma Eze} lives upstairs.
Name: {n:Roswitha Kessler}
The nurse {n:Imelda Quezada} was patient.
Attn: {n:Gregor Vanhoutte}
Poor {n:Ebenezer Ashworth} slipped on the ice.
{n:Lucinda O'Malley} called the fire brigade.
The winner was {n:Taavi Kask}, by a mile.
He married {n:Rosalind Thackeray} in May.
Sincerely, {n:Pernille Overgaard}
Her brother {n:Anton Zhukov} plays chess.
We thank {n:Hiroshi Tanabe} for the photos.
Ask {n:Delroy Campbell} about the roof.
{n:Monique Desrosiers} wrote the report.
Tell {n:Fatou Diallo} I said hello.
My vet {n:Callum Fraser} is on leave.
The judge, {n:Winifred Obasanjo}, agreed.
The garage of {n:Piotr Nowicki} burnt down.
Mail it to {n:Aurelio Zambrano}, {s:48 Thistle Lane}.
The agent {n:Birgit Solheim} showed us the flat.
Then {n:Kwabena Mensah} laughed.
{n:Zeynep Aksoy} teaches piano.
Nobody told {n:Igor Stepanov}.
That dog belongs to {n:Odette Marchand}!
According to {n:Lars Ekdahl} the lift is broken.
{n:Carmelita Reyes} lost her purse.
I owe {n:Jamal Prescott} an apology.
The mayor of Springfield opened the bridge.
We flew from New York to Los Angeles.
Mount Kilimanjaro is high.
They live near Lake Geneva.
The River Thames froze over.
On Monday Morning we left.
Turn left at Oxford Circus.
He works in Silicon Valley.
Happy New Year to all!
The Eiffel Tower was closed.
She studies at Princeton University.
We stayed in San Francisco for a week.
Read the Terms of Service first.
My Uncle Bob says hi.
Nigel told me to wait.
The Golden Gate Bridge is red.
I love Ginger.
In July Peter left.
Hyde Park was full.
I flew into Heathrow Airport.
The South Bank is noisy.
Ask for Mr. Ferguson.
Write to {e:tuesday.club@harbourmail.org} soon.
My address is {e:j_doe99@sub.domain.co.uk}.
reach me: {e:lena (at) posteo (dot) net}
it is {e:karl at fastpost dot io} now
{e:mailto-test+tag@ex-ample.com} bounced
<{e:a.b-c@x.museum}>
E-mail {e:o'brien@uni.edu}!
{e:x@y.zz} is short
send cvs to {e:JOBS@COMPANY.BIZ}
{e:first.last [at] web.de} works
score was 3 @ home
meet @ noon
the @handle is mine
user@localhost is no address
I paid 5@2.00
call {p:212-555-0147} after six
my cell is {p:(415) 555-0132}
{p:+44 20 7946 0958} is the London desk
ring {p:+49 30 901820} in Berlin
tel:{p:6465550119}
fax {p:303.555.0188}
{p:+33 1 70 18 99 00}
text {p:1-800-555-0199} for help
{p:702 555 0163 ext 4} please
dial {p:+61 2 5550 4321}
dial {p:nine oh two five five five oh one four four}
order no. 5550147 arrived
the year 1999-2003 was good
ISBN 978-3-16-148410-0
lot 20230415 expired
it cost 1,299.00 in 2021
flight 447 at 10:45
population 8,336,817
ratio 3.14159265
serial 0045-77-001
SSN {i:512-44-9087} was on the form
her social security number is {i:401 55 2210}
social insurance {i:046 454 286} please
my SIN: {i:193456787}
passport no. {i:C01X00T47 }
Passport, issued in the city of Hamburg on the third of May last year, number {i:X4479012}
driver's licence {i:D1234567}
DL: {i:K8812093}
license number, which I hope nobody copies from this letter, is {i:B7654321}
{i:219-09-9999} leaked
ssn 000-12-3456 is void
ssn 666-12-3456 is void
123-45-678 is a part
sin is a strong word
the passport was lost
license to fish
I live at {s:1600 Juniper Avenue}.
{s:221B Baker Street} is famous
{s:12 Rue de Rivoli} in Paris
office: {s:Hauptstrasse 12}
moved to {s:77 Old Mill Road, Apt 4}
{s:350 5th Ave} has a view
{s:Calle Mayor 15}, second floor
deliver to {s:9 Cherry Blossom Ct}
{s:Unit 3, 18 Quarry Lane} please
at {s:4010 W Belmont Ave}
{s:Rua Augusta 1508}
{s:Forty-two Wallaby Way}
Baker Street is long
turn onto Elm Street
2 blocks down Main Street
Route 66 is fun
the 5 o'clock road show
9 lives of a street cat
"""


def cases():
    """(text, [(start, end, type)])"""
    import re

    names = {"e": "email", "p": "phone", "i": "identity_number", "s": "street_address", "n": "name"}
    for line in SHEET.strip().split("\n"):
        line, out, spans, at = line.replace("\\n", "\n"), "", [], 0
        for m in re.finditer(r"\{([episn]):([^}]*)\}", line):
            out += line[at : m.start()]
            spans.append((len(out), len(out) + len(m.group(2).rstrip()), names[m.group(1)]))
            out += m.group(2)
            at = m.end()
        yield out + line[at:], spans
